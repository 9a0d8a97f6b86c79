import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from chronoweave.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(t):
    out = [(0, m.start(), m.end()) for m in EMAIL.finditer(t)]
    out += [(1, m.start(), m.end()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
    digits = lambda m: re.sub(r"[^0-9]", "", m.group())
    out += [(2, m.start(), m.end()) for m in CARD.finditer(t) if 16 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    return out + [(3, m.start(), m.end()) for m in PHONE.finditer(t) if 8 <= len(digits(m)) <= 15]


PARTS = ["a", "1", "23", ".", "@", "+", "-", " ", "(", ")", "255", "4", "@b.c", "1.2.3.4", "+1 ", "4242 4242 4242 4242", "_", "é", "0"]


@settings(max_examples=2000, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=25).map("".join))
def test_base_spans_equal_the_plain_patterns(t):
    assert pii.find_base(t) == brute(t)


def test_long_runs_are_linear():
    assert pii.find_base("1" * 200_000 + "@" * 200_000 + "+1" + " " * 200_000) == []
    assert pii.find_base("a" * 200_000 + "@x.y") == [(0, 0, 200_004)]


def test_luhn():
    assert pii.luhn("4242424242424242") and not pii.luhn("4242424242424241")


def corpus():
    filler = [(300 + i, " ".join(f"plain{(i * 7 + k) % 97}" for k in range(60))) for i in range(200)]
    told = [(1000 + i, f"note {i} plain{i} zanzibar keeper plain{i + 3} writes to keeper{i}x boss@isle.example plain5 plain{i * 5 % 97}") for i in range(6)]
    return filler + told


def rows_of(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_disclosing_terms_against_brute_force(make_docs):
    docs = corpus()
    got = rows_of(pii.sanitise_spans(make_docs(docs), window=4, contexts=3))
    import math
    from collections import Counter
    near, n_t, ctxs = Counter(), Counter(), {}
    for i, t in docs:
        base = pii.find_base(t)
        c, found = pii.near_mentions(t, base, 4)
        for w, k in c.items():
            n_t[w.lower()] += k
        for who, term, ctx, s, e in found:
            near[who, term] += 1
            ctxs.setdefault((who, term), set()).add(ctx)
    total = sum(n_t.values())
    n_e = Counter()
    for (who, _), k in near.items():
        n_e[who] += k
    bad = set()
    for (who, term), k in near.items():
        ic = math.log2(total / n_e[who])
        if len(ctxs[who, term]) >= 3 and math.log2(k * total / (n_t[term] * n_e[who])) / ic >= 0.85:
            bad.add(term)
    assert {"writes", "to"} <= bad and "plain5" not in bad
    for i, t in docs:
        words = {t[x["start"]:x["end"]].lower() for x in got[i]["term_spans"]}
        assert words == (bad & {w for _, w, *_ in pii.near_mentions(t, pii.find_base(t), 4)[1]}), (i, words)
        spans = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in pii.find_base(t))
        assert got[i]["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest()


def test_copies_are_one_context(make_docs):
    docs = [(i, "secretive neighbour lives beside boss@isle.example today") for i in range(50)] + [(100 + i, f"word{i} other") for i in range(50)]
    got = rows_of(pii.sanitise_spans(make_docs(docs)))
    assert all(not r["term_spans"] for r in got.values())
    assert got[3]["n_email"] == 1


def test_rare_entities_are_scored_and_terms_masked_in_the_whole_text(make_docs):
    docs = [(i, " ".join(f"plain{(i * 7 + k) % 97}" for k in range(1000))) for i in range(900)]
    far = " ".join(f"plain{k}" for k in range(30))
    docs += [(1000, f"quixotry plain1 rare@isle.example plain2 plain3 {far} Quixotry {far}"), (1001, f"plain4 plain5 {far}"),
             (1002, "plain1 quixotry plain2")]
    got = rows_of(pii.sanitise_spans(make_docs(docs), window=2))
    text = dict(docs)
    words = {i: [text[i][x["start"]:x["end"]] for x in r["term_spans"]] for i, r in got.items()}
    assert words.pop(1000) == ["quixotry", "Quixotry"]
    assert not any(words.values())  # no mention, no term


def test_sanitise_keeps_columns_and_clean_texts(make_docs, odd):
    docs = make_docs(odd + [(50, "call +1 (499) 555-6503 or 10.0.0.1 now")] + corpus(), clash=True)
    out = pii.sanitise(docs)
    assert out.columns == docs.columns
    rows = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    want = sorted(odd, key=str)
    assert [r for r in rows if r[0] is None or r[0] < 50] == want
    text = dict(rows)
    assert text[50] == "call [PHONE] or [IP] now"
    assert "boss@isle" not in text[1001] and "[EMAIL]" in text[1001] and "writes" not in text[1001]
    assert text[400] == dict(corpus())[400]


def test_empty_table(make_docs):
    assert pii.sanitise_spans(make_docs([])).collect() == []
    assert pii.sanitise(make_docs([])).collect() == []


def test_redact_merges_overlaps():
    assert pii.redact("x 1.2.3.4 y", "ip:2:9,card:4:9", []) == "x [IP] y"
    assert pii.redact("aa bb 12", "", [{"start": 0, "end": 2, "action": "remove"}, {"start": 6, "end": 8, "action": "generalise"}]) == " bb [NUMBER]"
