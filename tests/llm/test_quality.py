import re
from collections import Counter

from chronoweave.llm import quality


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    c = Counter(grams)
    rep = {i + k for i, g in enumerate(grams) if c[g] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(rep)


def test_measures_against_brute_force(make_docs, odd):
    rows = odd + [(30, "a b c a b c x\n\x0b\na b c\n a b \x1c c\x85d\na b c"), (31, "# $ % & | < > *\n#\n#"), (32, "w " * 60)]
    got = quality.ledger(make_docs(rows, clash=True)).collect()
    have = sorted(((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got), key=str)
    assert have == sorted(((i, *brute(t)) for i, t in rows), key=str)
    assert quality.ledger(make_docs([])).collect() == []


def test_bits_policies_and_ablations(spark, make_docs):
    good = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80))
    rows = [(1, good), (2, "short"), (3, "same words again " * 40), (4, good.upper()), (5, "### " * 30 + good), (6, "### " * 40 + good.upper())]
    led = quality.ledger(make_docs(rows))
    names = [r.name for r in quality.rules()]
    bits = {r["doc_id"]: {names[i] for i in range(len(names)) if r["failures"] >> i & 1} for r in led.collect()}
    assert not bits[1] and "too_few_words" in bits[2] and "repeated_trigrams" in bits[3] and "upper_case" in bits[4]
    for version, policy in quality.POLICIES.items():
        kept = {r["doc_id"] for r in led.where(quality.verdict(policy)).collect()}
        want = {d for d, b in bits.items() if not b & set(policy.reject) and len(b & set(policy.count)) <= policy.spare}
        assert kept == want, version
    policy = quality.POLICIES["v2"]
    table = {r["rule"]: r for r in quality.ablations(led, policy).collect()}
    assert set(table) == set(names)
    for rule in names:
        keeps = lambda b: not b & set(policy.reject) and len(b & set(policy.count)) <= policy.spare
        assert table[rule]["n_failed"] == sum(rule in b for b in bits.values())
        assert table[rule]["n_failed_alone"] == sum(b == {rule} for b in bits.values())
        assert table[rule]["n_kept"] == sum(map(keeps, bits.values()))
        assert table[rule]["n_kept_without"] == sum(keeps(b - {rule}) for b in bits.values())


def test_kept_columns(make_docs, odd):
    docs = make_docs(odd, clash=True)
    led = quality.ledger(docs, keep=tuple(docs.columns))
    assert {"text", "doc_n_chars", "doc_n_words", "n_words", "lang"} <= set(led.columns)
    assert led.count() == len(odd)
