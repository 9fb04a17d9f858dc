"""The pipeline against brute-force versions of its stages, each on its own input."""

import corpus_pipeline as P
from helpers import awkward, documents, prose
from test_decontaminate import brute as hits
from test_jaccard import brute as groups
from test_jaccard import shingles
from test_repeats import brute as repeats
from test_bpe import PATH
from tessera.llm import bpe

ROWS = awkward() + [(30, prose(90, 200)), (31, prose(90, 200) + " more"), (32, prose(91, 150) + " " + prose(92, 40)), (33, prose(93, 90) + " " + prose(92, 90))]


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages(spark, tmp_out):
    docs = documents(spark, ROWS)
    spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int").write.parquet(f"{tmp_out}/labels.parquet")
    spark.createDataFrame([(1, prose(91, 20)), (2, "one")], "item_id long, text string").write.parquet(f"{tmp_out}/benchmark.parquet")
    stage = dict(P.STAGES)
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "repeats", "decontaminate", "encode"]

    kept = stage["quality"](spark, docs, tmp_out)
    assert kept.columns == docs.columns and sorted(map(str, pairs(kept))) == sorted(map(str, ROWS))  # one class: all stay

    single = stage["near_duplicates"](spark, kept, tmp_out)
    want = {c for _, n, c in groups(ROWS, 5, 80) if n}
    got = [d for d, t in pairs(single) if shingles(t, 5)]
    assert single.columns == docs.columns and set(got) == want and len(got) == len(want)

    before = pairs(single)
    cut = stage["repeats"](spark, single, tmp_out)
    left = [(d, k.decode(errors="ignore")) for d, n, r, _, k in repeats(before, 400) if n == 0 or r < n]
    assert cut.columns == docs.columns and sorted((d or -1, t) for d, t in pairs(cut)) == sorted((d or -1, t) for d, t in left)

    clean = stage["decontaminate"](spark, cut, tmp_out)
    bench = [(1, prose(91, 20)), (2, "one")]
    keep = [(d, t) for d, t in pairs(cut) if not (lambda n, h, _: h and 20 * h >= n)(*hits(t, bench))]
    assert clean.columns == docs.columns and sorted(map(str, pairs(clean))) == sorted(map(str, keep)) and len(keep) < len(left)

    coded = stage["encode"](spark, clean, tmp_out).collect()
    words = bpe.words_for(PATH)
    assert sorted((str(r.doc_id), r.decoded) for r in coded) == sorted((str(d), t or "") for d, t in keep)
    assert all(r.n_tokens == len(words.tokenizer.encode(r.decoded, add_special_tokens=False).ids) for r in coded)


def test_stages_keep_columns_named_like_those_of_operators(spark, tmp_out):
    names = ["kept", "n_bytes", "n_removed", "spans", "n_words", "n_hit", "items", "n_shingles", "component_id", "first", "row", "class"]
    names += ["score", "predicted", "quality", "block", "kind", "start", "end", "__row", "__lead"]
    rows = [r for r in ROWS if r[0] not in (2, 7, 8)]
    docs = documents(spark, rows).selectExpr("*", *[f"concat('{n}-', doc_id) as `{n}`" for n in names])
    spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int").write.parquet(f"{tmp_out}/labels.parquet")
    spark.createDataFrame([(1, prose(91, 20)), (2, "one")], "item_id long, text string").write.parquet(f"{tmp_out}/benchmark.parquet")
    for name, stage in P.STAGES:
        out = stage(spark, docs, tmp_out)
        left = out.columns if name == "encode" else docs.columns
        assert out.columns == left and set(names) <= set(left)
        got = out.collect()
        assert got
        for r in got:
            assert [r[n] for n in names] == [None if r.doc_id is None else f"{n}-{r.doc_id}" for n in names]
            if name == "repeats":
                assert r.n_chars == len(r.text)


def test_run(spark):
    got = P.run(spark, "/root/testdata/sf0.001")
    assert 0 < got.count() < 200 and "ids" in got.columns
