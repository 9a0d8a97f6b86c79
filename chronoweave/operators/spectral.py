"""Spectral features (I08) and bump wavelets (H09) on blocks.

The spectrum is Welch's: windowed segments of a fixed length that overlap by half are transformed and their powers averaged, so
segments are the unit of work and a long series is many of them.  Wavelet responses are convolutions with a
kernel of bounded reach, done block by block with the fast Fourier transform (overlap-save): a block is
transformed with the rows around it, and only its own rows are kept.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.panel import ID, Y
from chronoweave.plans.blocks import ARRAY_ROWS, BLOCK, _bounded, gather, map_blocks
from chronoweave.plans.series import POS, _keys, positioned

#: centre and half width of the bump wavelet in radians per step at scale 1
BUMP_MU, BUMP_SIGMA = 5.0, 0.6
#: reach of the truncated bump kernel in steps at scale 1; beyond it the kernel is below 1e-6 of its peak
BUMP_REACH = 160


def segment_power(y: np.ndarray, length: int) -> np.ndarray:
    """Powers of the segment's rows less their mean, under a Hann window, at frequencies 1/length .. 1/2."""
    return np.abs(np.fft.rfft((y - y.mean()) * np.hanning(length + 1)[:-1])[1:]) ** 2


def spectral_features(df: DataFrame, value_col: str = Y, length: int = 256, freq: str | None = None, id_cols: str | Sequence[str] = ID,
                      block_rows: int = ARRAY_ROWS, digits: int = 6) -> DataFrame:
    """(keys, segments, spectral_entropy, dominant_period).

    Segments have ``length`` rows, or the largest power of two that a shorter series holds, and start every half
    length from the first row.  The entropy of the averaged power shares is divided by that of a flat
    spectrum: 1 for white noise, near 0 for a pure cycle.  The dominant period is the one with the most power (the longest of
    equals).  Series must be on a regular grid without NULLs; with under 8 rows, or no variance, both are NULL."""
    keys = _keys(id_cols)
    x = positioned(df.where(F.col(value_col).isNotNull()), keys, freq)[0].select(*keys, POS, F.col(value_col).cast("double").alias("_v"))
    size = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(POS).alias("_p0"))
    span = F.least(F.lit(length), F.pow(2.0, F.floor(F.log2("_n") + 1e-12))).cast("long")
    x = x.join(size.withColumn("_len", span), keys).withColumn(POS, F.col(POS) - F.col("_p0"))
    blocks = gather(x, ["_v"], keys, POS, F.ceil(F.lit(max(block_rows, length)) / F.col("_len")) * F.col("_len"), 0, F.col("_len"), ["_len", "_n"])
    head = ", ".join(f"`{k}` {blocks.schema[k].dataType.simpleString()}" for k in keys)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, count, power = [], [], []
            for i, row in enumerate(b.to_pylist()):
                n, v, first = row["_len"], np.array(row["_v"], float), row["_p"][0]
                if row["_n"] < 8:
                    continue
                half = n // 2
                starts = [s for s in range(row["_lo"], row["_lo"] + row["_size"], half) if s + n <= first + len(v)]
                if starts:
                    at.append(i)
                    count.append(len(starts))
                    power.append(np.sum([segment_power(v[s - first:s - first + n], n) for s in starts], axis=0).tolist())
            yield pa.RecordBatch.from_arrays([b.column(k).take(pa.array(at, pa.int64())) for k in keys] + [pa.array(count, pa.int64()), pa.array(power, pa.list_(pa.float64()))],
                                             [*keys, "c", "p"])
    parts = _bounded(blocks.drop(BLOCK)).mapInArrow(work, f"{head}, c long, p array<double>")
    count = parts.groupBy(*keys).agg(F.sum("c").alias("segments"))
    power = parts.select(*keys, F.posexplode("p").alias("f", "p")).groupBy(*keys, "f").agg(F.sum("p").alias("p"))
    total = power.groupBy(*keys).agg(F.sum("p").alias("_t"), F.count(F.lit(1)).alias("_k"), F.max_by("f", F.struct("p", -F.col("f"))).alias("_f"))
    share = F.try_divide(F.col("p"), F.when(F.col("_t") > 1e-20, F.col("_t")))
    out = power.join(total, keys).groupBy(*keys).agg(
        (-F.sum(F.when(share > 0, share * F.ln(share))) / F.ln(F.first("_k"))).alias("e"), (2 * F.first("_k") / (F.first("_f") + 1)).alias("d"), F.first("_t").alias("_t"))
    ok = F.col("_t") > 1e-20
    return size.select(*keys).join(count, keys, "left").join(out, keys, "left").select(
        *keys, F.coalesce("segments", F.lit(0)).alias("segments"), F.round(F.when(ok, F.col("e")), digits).alias("spectral_entropy"),
        F.round(F.when(ok, F.col("d")), digits).alias("dominant_period"))


def bump_kernel(scale: float, reach: int) -> np.ndarray:
    """The bump wavelet at ``scale``, sampled at steps -reach .. reach: the inverse transform of
    exp(1 - 1 / (1 - ((s w - 5) / 0.6)^2)) where |s w - 5| < 0.6, times sqrt(scale)."""
    size = 1 << int(np.ceil(np.log2(8 * reach)))
    w = 2 * np.pi * np.fft.fftfreq(size)
    u = (scale * w - BUMP_MU) / BUMP_SIGMA
    shape = np.zeros(size)
    inside = np.abs(u) < 1
    shape[inside] = np.exp(1 - 1 / (1 - u[inside] ** 2))
    k = np.fft.ifft(shape) * np.sqrt(scale)
    return np.r_[k[-reach:], k[:reach + 1]]


def overlap_save(y: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """Same-length convolution with a centred kernel by one transform of the block."""
    reach = (len(kernel) - 1) // 2
    size = 1 << int(np.ceil(np.log2(len(y) + len(kernel))))
    out = np.fft.ifft(np.fft.fft(y, size) * np.fft.fft(kernel, size))
    return out[reach:reach + len(y)]


def augment_bump_wavelet(df: DataFrame, value_col: str = Y, scales: Sequence[float] = (2, 7), sample_rate: float = 1.0, freq: str | None = None,
                         id_cols: str | Sequence[str] = ID, block_rows: int = ARRAY_ROWS, digits: int | None = 6) -> DataFrame:
    """Rows of ``df`` with ``<col>_bump_<scale>_real`` and ``_abs``: the wavelet transform at each scale.

    Time counts ``sample_rate`` rows as one unit, so a scale s stands for s * sample_rate rows and answers cycles of
    s * sample_rate * 2 pi / 5 rows most (below 1.6 rows there are none).  Beyond the ends of a series the values count as 0, NULLs as well.  The kernel is cut
    where it is below 1e-6 of its peak (160 scales)."""
    keys = _keys(id_cols)
    rows = [s * sample_rate for s in scales]
    reach = max(int(BUMP_REACH * s) for s in rows)
    x, _ = positioned(df, keys, freq)
    blocks = gather(x.select(*keys, POS, F.coalesce(F.col(value_col).cast("double"), F.lit(0.0)).alias("_v")), ["_v"], keys, POS, max(block_rows, reach), reach, reach)

    def respond(p, own, v):
        out = {}
        for i, s in enumerate(rows):
            c = overlap_save(v, bump_kernel(s, int(BUMP_REACH * s)))[own]
            out |= {f"_r{i}": c.real, f"_a{i}": np.abs(c)}
        return out
    names = {f"_{c}{i}": f"{value_col}_bump_{s:g}_{n}" for i, s in enumerate(scales) for c, n in (("r", "real"), ("a", "abs"))}
    found = map_blocks(blocks, respond, {n: "double" for n in names}, ["_v"], keys, POS)
    values = [(F.col(o) if digits is None else F.round(o, digits)).alias(n) for o, n in names.items()]
    return x.join(found, [*keys, POS]).select(*df.columns, *values)
