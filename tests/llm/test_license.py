import random
import re

from helpers import awkward, frame
from tessera.llm import license as L


def brute_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(L.LOWER))
    hits = []
    for phrase, label in L.PHRASES.items():
        p = phrase.split()
        hits += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    return len(words), sorted(hits)


CASES = [
    (1, "Licensed under the Apache License, Version 2.0. MIT License MIT-License; gnu GENERAL public license"),
    (2, "Licensd under the Apache Licence, Version 2.0."),
    (3, "Relased under the MIT Licens. Ünd mehr CC BY CC/BY"),
    (4, "the mitt license of smith licenses"),
    (5, "Permission is hereby granted, free of charge, to any person obtaning a copy"),
]


def test_base_places_match_brute_force(spark):
    rows = CASES + awkward()
    got = L.license_scan(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = sorted((d or -1, *brute_base(t)) for d, t in rows)
    mine = sorted((r.doc_id or -1, r.n_words, sorted((m.first_word, m.label) for m in r.matches if m.kind == "exact")) for r in got)
    assert mine == want


def test_edits_are_found_and_placed(spark):
    got = {r.doc_id: r.matches for r in L.license_scan(frame(spark, CASES)).collect()}
    text = dict(CASES)
    near = {d: [m for m in ms if m.kind == "near"] for d, ms in got.items()}
    assert [m.label for m in near[2]] == ["apache-2.0"] and near[2][0].edits > 0 and near[2][0].score < 1
    assert text[2][near[2][0].start : near[2][0].end] == "Licensd under the Apache Licence, Version 2.0"
    assert [m.label for m in near[3]] == ["mit"]
    assert near[4] == []
    assert [m.label for m in near[5]] == ["mit"]


def test_pieces_cover_a_notice():
    for notice in L.NOTICES:
        cut = L.pieces(notice)
        assert "".join(p for _, p in cut) == notice and len(cut) == L.edits(len(notice)) + 1


def test_each_notice_is_told_from_all_others(spark):
    rows = [(i, f"Foo. {n.title()}! Bar") for i, n in enumerate(L.NOTICES)]
    rows += [(100, "Licensed under CC BY-SA 4.0; licensed under CC BY-NC 4.0"), (101, "licensd under cc by nc 4 0"), (102, "licensed under cc by na 4 0")]
    got = {r.doc_id: [(m.label, m.edits) for m in r.matches if m.kind == "near"] for r in L.license_scan(frame(spark, rows)).collect()}
    for i, label in enumerate(L.NOTICES.values()):
        assert got[i] == [(label, 0)]
    assert got[100] == [("cc-by-sa", 0), ("cc-by-nc", 0)]
    assert got[101] == [("cc-by-nc", 1)]
    assert sorted(got[102]) == [("cc-by-nc", 1), ("cc-by-sa", 1)]  # as near to both


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def brute_places(text, notice):
    """(start, end, edits): the best of all spans of words, and so on on either side."""
    words = [m.span() for m in re.finditer(r"\w+", text)]
    k = L.edits(len(notice))
    spans = [(a, b) for i, (a, _) in enumerate(words) for _, b in words[i:] if abs(b - a - len(notice)) <= k]
    near = sorted((distance(text[a:b], notice), a, b) for a, b in spans)
    out = []
    for n, a, b in near:
        if n <= k and all(b <= x or y <= a for x, y, _ in out):
            out.append((a, b, n))
    return sorted(out)


def test_adjacent_edited_and_exact_notices_match_brute_force():
    for notice in ("released under the mit license", "licensed under the apache license version 2 0", "licensed under cc by nc 4 0"):
        edited = notice.replace("licens", "licns", 1).replace("under", "undr")
        for parts in ((edited, notice), (notice, edited), (edited, edited, notice), (edited, "and", notice, edited, "or", edited, notice)):
            text = " ".join(parts)
            want = brute_places(text, notice)
            assert len(want) == len([p for p in parts if len(p) > 3])
            assert sorted((a, b, n) for _, a, b, n, _ in L.find_notices(text, {notice: "x"})) == want
    text = "relased under the mit licens released under the mit license"
    assert sorted(m[1:4] for m in L.find_notices(text, L.NOTICES)) == [(0, 28, 2), (29, 59, 0)]


def test_work_grows_with_the_text_and_places_stay_right():
    """A long text full of slightly broken notices: every one is found, in time in proportion to the text."""
    import time

    rnd = random.Random(6)
    broken = []
    for i in range(12_000):
        notice = rnd.choice(list(L.NOTICES)[:8])
        at = rnd.randrange(4, len(notice) - 4)
        broken.append(notice[:at] + "x" + notice[at + 1 :] if notice[at] != " " and i % 5 else notice)
    text = " ".join(broken)
    seconds = []
    for part in (text[: len(text) // 4], text):
        began = time.process_time()
        found = L.find_notices(part, L.NOTICES)
        seconds.append(time.process_time() - began)
    assert len(text) > 500_000 and len(found) >= len(broken)
    assert seconds[1] < 8 * seconds[0] + 1  # four times the text; a square would take sixteen times as long
    few = " ".join(broken[:6])
    for notice in L.NOTICES:
        assert sorted(L.places(notice, few)) == brute_places(few, notice)


def test_places_within_better_ones_match_brute_force():
    rnd = random.Random(5)
    for _ in range(300):
        found = [("x", a, a + rnd.randint(1, 9), rnd.randint(0, 3), 1.0) for a in (rnd.randint(0, 20) for _ in range(rnd.randint(0, 8)))]
        want = [m for m in found if not any(o[1] <= m[1] and m[2] <= o[2] and o[3] < m[3] for o in found)]
        assert sorted(L.fewest_edits(found)) == sorted(want)


def test_empty_table_and_clashing_columns(spark):
    assert L.license_scan(frame(spark, [])).count() == 0
    assert L.license_scan(frame(spark, CASES, extra="matches")).columns == ["doc_id", "n_words", "matches"]


def test_query(spark, sf_dir):
    import __spark_entry__ as E

    rows = {r.doc_id: r for r in E.queries()["op3_license_scan"](spark, sf_dir).collect()}
    for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        n, hits = brute_base(d.text)
        r = rows[d.doc_id]
        assert (r.n_words, r.n_base, r.base_labels) == (n, len(hits), ",".join(sorted({h for _, h in hits})))
        assert (r.first_word, r.last_word) == ((hits[0][0], hits[-1][0]) if hits else (None, None))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
