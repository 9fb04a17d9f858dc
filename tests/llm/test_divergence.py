import random
import re
from collections import Counter, defaultdict

from helpers import prose

from tessera.llm import divergence as D

SCHEMA = "doc_id long, lang string, source string, text string"


def brute(rows, min_docs, smoothing, scale, top):
    lower = {c: c + 32 for c in range(65, 91)}
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))) for _, lang, source, text in rows]
    df, total, count = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        df[lang].update(set(terms))
        total[lang].update(terms)
        count[lang, source].update(terms)
    out = []
    for (lang, source), mine in count.items():
        kept = [t for t, n in df[lang].items() if n >= min_docs]

        def shares(c, kept=kept):
            below = sum(c[t] for t in kept) + smoothing * len(kept)
            return {t: 1 + scale * (c[t] + smoothing) // below for t in kept}

        p, q = shares(mine), shares(total[lang])
        pairs = []
        for (other_lang, other), c in count.items():
            if other_lang == lang and other != source:
                r = shares(c)
                pairs.append((-sum(abs(p[t] - r[t]) for t in kept), other.encode()))
        terms = [(q[t] - p[t], t.encode()) for t in kept if mine[t] and p[t] > q[t]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            out += [(lang, source, part, item.decode(), -value, i) for i, (value, item) in enumerate(found, 1)]
    return sorted(out)


def mixed(n=60):
    rnd = random.Random(5)
    rows = [(i, rnd.choice(["en", "en", "fr", None]), rnd.choice(["a", "a", "b", "ç", None]), prose(i, rnd.randrange(80))) for i in range(n)]
    rows += [rows[0], rows[0], (n, "en", "b", None), (None, "en", "", ""), (n, "zz", "only", "Word"), (n, "fr", "b", prose(9, 20_000)), (n, None, "x", " 12 ")]
    return rows


def got(spark, rows, **args):
    found = D.audit(spark.createDataFrame(rows, SCHEMA), **args)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, found.collect()))


def test_audit_equals_brute_force(spark):
    for args in (dict(min_docs=1, smoothing=5, scale=10**9, top=50), dict(min_docs=8, smoothing=1, scale=1000, top=7), dict(min_docs=10**6, smoothing=5, scale=10**9, top=50)):
        assert got(spark, mixed(), **args) == brute(mixed(), **args)


def test_tiles_and_buckets_change_nothing(spark, monkeypatch):
    rnd = random.Random(6)
    rows = [(i, "en", f"s{rnd.randrange(9)}", prose(i, 40)) for i in range(50)]
    args = dict(min_docs=2, smoothing=5, scale=10**9, top=50)
    monkeypatch.setattr(D, "TILE", 2)
    monkeypatch.setattr(D, "BUCKET", 5)
    assert got(spark, rows, **args) == brute(rows, **args)


def test_ties_are_cut_in_utf8_order(spark):
    rows = [(1, "en", "a", "zz éé aa bb Ab cc dd ee"), (2, "en", "b", "other")]
    args = dict(min_docs=1, smoothing=5, scale=10**9, top=3)
    found = [r for r in got(spark, rows, **args) if r[1:3] == ("a", "term")]
    assert [r[3] for r in sorted(found, key=lambda r: r[5])] == ["aa", "ab", "bb"]
    assert got(spark, rows, **args) == brute(rows, **args)


def test_counts_beyond_64_bits_stay_exact(spark):
    row = spark.createDataFrame([(9 * 10**17, 3 * 10**18, 7)], "n long, total long, v long")
    p = row.select(D.share("n", "total", 5, 10**9)).first()[0]
    assert p == 1 + 10**9 * (9 * 10**17 + 5) // (3 * 10**18 + 35)


def test_empty_table_and_clashing_columns(spark):
    assert got(spark, [], min_docs=1) == []
    rows = [(1, "en", "a", "x y"), (2, "en", "b", "x z")]
    plain = spark.createDataFrame(rows, SCHEMA)
    clashing = plain.selectExpr("*", "1 as term", "2 as value", "3 as v", "4 as total", "'q' as part")
    assert sorted(D.audit(clashing, 1).collect()) == sorted(D.audit(plain, 1).collect())


def test_long_texts_are_cut_at_spaces():
    from tessera.llm.words import cut_at_spaces

    text = b"ab cde  f " * 50 + b"x" * 40 + b" y"
    pieces = list(cut_at_spaces(text, 16))
    assert [w for p in pieces for w in p.split()] == text.split() and max(map(len, pieces)) == 40
