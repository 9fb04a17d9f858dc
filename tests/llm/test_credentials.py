import hashlib
import random
import re
import string

import pytest
from helpers import awkward, frame, prose

from tessera.llm import credentials as C
from tessera.llm.queries import REGISTRY

LETTERS = string.ascii_letters + string.digits


def key(seed, n, signs=LETTERS):
    return "".join(random.Random(seed).choices(signs, k=n))


def brute_base(text):
    """(start, kind, end) in code points, straight from the definition; (?a:...) keeps case folding to ASCII."""
    text = text or ""
    found = []
    name = "|".join("".join(f"[{c}{c.upper()}]" for c in n) for n in ("password", "passwd", "secret", "token")) + "|[aA][pP][iI]_?[kK][eE][yY]"
    for m in re.finditer(rf"""({name})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(2)) >= 8:
            found.append((m.start(), 0, m.end()))
    for kind, pattern, least in ((1, "AKIA[A-Z0-9]+", 16), (2, "[0-9a-f]+", 32)):
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if m.end() - m.start() >= least]
    return sorted(found)


TEXTS = [
    'password = "hunter2hunter2" and Token:abcdefgh API_KEY=\'x1.y2=z3-\' apikey: "short"',
    "token: token: secret=abcdefgh1 passwd==12345678 password:\tnottabbed1 tokenlike 12345678",
    "ſecret=abcdefgh toKen=abcdefgh toKEN = é12345678 geheim SECRET  =  ABCDEFGHIJ",
    "AKIAABCDEFGHIJKL AKIAABCDEFGHIJK AKIA AKIAAKIAAKIAAKIAxyz éAKIA0123456789AB",
    "é" * 5 + key(1, 32, "0123456789abcdef") + " " + key(2, 31, "0123456789abcdef") + "g" + key(3, 64, "0123456789abcdef") + "G",
    "token = " + key(4, 40, "0123456789abcdef") + "\ntoken=\n" + key(5, 40, "0123456789abcdef"),
    "token:secret=abcdefgh password='' = x secret\"='........'",
]


def cases():
    return [(100 + i, t) for i, t in enumerate(TEXTS)] + awkward()


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return C.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_base_spans_equal_brute_force(spark, model):
    got = C.find_secrets(frame(spark, cases()), model).collect()
    mine = [(r.doc_id or -1, [(m.start, C.KINDS.index(m.kind), m.end) for m in r.matches if m.kind != "markov"]) for r in got]
    assert sorted(mine) == sorted((d or -1, brute_base(t)) for d, t in cases())
    assert sum(len(m) for _, m in mine) > 15


def test_random_strings_are_found_and_identifiers_are_not(spark, model):
    hidden = [key(i, 24 + i % 17) for i in range(300)]
    rows = [(i, f"é {prose(i, 10)} id {k} {prose(i + 1, 5)}") for i, k in enumerate(hidden)]
    plain = ["internationalization_of_user_interfaces", "donaudampfschifffahrtsgesellschaft", "src/main/python/package", "4539148803436467", "einlichkeitverkeitach"]
    rows += [(1000 + i, f"see {p} there") for i, p in enumerate(plain)]
    got = {r.doc_id: r.matches for r in C.find_secrets(frame(spark, rows), model).collect()}
    text = dict(rows)
    found = sum([text[i][m.start : m.end] for m in got[i]] == [k] for i, k in enumerate(hidden))
    assert found >= 290
    assert all(m.kind == "markov" and m.score > model.least for i in range(300) for m in got[i])
    assert [got[1000 + i] for i in range(len(plain))] == [[]] * len(plain)


def test_scores_equal_a_slow_sum(model):
    runs = [key(i, 16 + i) for i in range(5)] + ["=" * 16]
    fast = C.scores([r.encode() for r in runs], model)
    for r, s in zip(runs, fast, strict=True):
        codes = [0, *(C.SIGNS.index(c) + 1 for c in r.encode())]
        assert abs(sum(model.ratio[a, b] for a, b in zip(codes, codes[1:])) - s) < 1e-9


def test_models_are_the_shares_of_labelled_transitions(spark):
    text = "aaaaaaaab " + "0f" * 16
    model = C.fit(frame(spark, [(1, text), (2, text), (3, None)]))
    a, b = (C.SIGNS.index(c) + 1 for c in b"ab")
    n = len(C.SIGNS)
    plain = (1 + C.SMOOTHING) / (8 + C.SMOOTHING * n)  # a is followed by a seven times and by b once
    assert abs(model.ratio[a, b] - C.np.log(1 / n / plain)) < 1e-9
    assert abs(model.least - C.math.log(99)) < 1e-9  # one string of each label


def test_sample_is_bounded(spark):
    rows = [(i, f"ordinary{i}word and more") for i in range(50)]
    few = C.fit(frame(spark, rows), sample=5)
    assert abs(few.least - C.math.log(99 * 6)) < 1e-9
    assert C.fit(frame(spark, [])).least == C.math.log(99)


def test_redacted_texts_and_clashing_columns(spark, model):
    rows = [(1, "a token=abcdefgh1 é"), (2, None), (3, "token = " + "0af1" * 10), (4, "x")]
    docs = frame(spark, rows).selectExpr("*", "'q' as kind", "7 as score", "'old' as matches")
    got = {r.doc_id: (r.redacted, r.kind, r.score) for r in C.find_secrets(docs, model, mark="<>").collect()}
    assert got == {1: ("a <> é", "q", 7), 2: ("", "q", 7), 3: ("<>", "q", 7), 4: ("x", "q", 7)}


def test_query_equals_brute_force_on_base_kinds(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = REGISTRY["op13_secrets"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = brute_base(docs[r.doc_id])
        named = [f"{C.KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in base) for i in range(3)]
        assert r.base_sha256 == hashlib.sha256(",".join(named).encode()).hexdigest()
        assert set(named) <= set(r.spans.split(","))
