import pytest

from tessera.llm import urls as U

PAGES = [
    (1, "http://A.Net/x"), (2, "https://www.example.net/en/1?x#y"), (3, "http://example.net/en"), (4, "http://example.com/de/q"),
    (5, "http://xexample.com/de/q"), (6, "http://m.k.org/fr/"), (7, "http://k.org/fr"), (8, "no scheme"), (9, None), (10, ""),
    (11, "http://example.net"), (12, "ftp://ÄB.org/fr/x"), (13, "http://h.com?x=a://b.net/"), (14, "://net/"), (15, "http://.net/"),
    (2, "https://www.example.net/en/1?x#y"), (16, "http://a.b.c.d.example.net/en/"),
]


def brute(url, rules):
    rest = (url or "").partition("://")[2]
    for i, c in enumerate(rest):
        if c in "?#":
            rest = rest[:i]
            break
    host, slash, path = rest.partition("/")
    host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in host), slash + path
    fits = []
    for rule, verdict in rules.items():
        h, s, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(s + p):
            fits.append((len(rule), rule, verdict))
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def judged(spark, rules, pages=PAGES):
    df = spark.createDataFrame(pages, "page_id long, url string").selectExpr("*", "'z' as rule")
    return U.filter_urls(df, U.rule_table(spark, rules))


@pytest.mark.parametrize("segment", [1 << 20, 20])
def test_matches_brute_force(spark, monkeypatch, segment):
    monkeypatch.setattr(U, "SEGMENT_BYTES", segment)  # the second deals the rules over several files
    rules = U.RULES | {"b.c.d.example.net/": "block", "k.org/fr/": "block"}
    got = judged(spark, rules).collect()
    want = [(p, *brute(u, rules)) for p, u in PAGES]
    assert sorted((r.page_id, r.host, r.path, str(r.rule), str(r.verdict)) for r in got) == sorted((*w[:3], str(w[3]), str(w[4])) for w in want)


def test_keys_that_collide_are_told_apart(monkeypatch, tmp_out):
    monkeypatch.setattr(U.xxhash, "xxh64_intdigest", lambda data: len(data) % 3)
    rules = [(f"h{i}.org/", "block" if i % 2 else "allow") for i in range(40)]
    digests = U.Digests(U.write_digests(rules, tmp_out))
    found = digests.find([r.encode() for r, _ in rules] + [b"h99.org/", b"other"])
    assert (found[-2:] == -1).all() and len(set(found[:-2].tolist())) == 40
    assert [bool(digests.block[i]) for i in found[:-2]] == [v == "block" for _, v in rules]


def test_empty_tables(spark):
    assert judged(spark, U.RULES, []).count() == 0
    none = U.filter_urls(spark.createDataFrame(PAGES, "page_id long, url string"), U.rule_table(spark, U.RULES).limit(0))
    assert none.filter("rule is not null or verdict is not null").count() == 0 and none.count() == len(PAGES)


def test_bad_names_are_blocked_under_all_domains(spark, tmp_out):
    import __spark_entry__ as E

    names = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]
    hosts = [f"{n}.{d}" for n in names for d in ("com", "net", "org", "example.com", "example.net", "example.org")]
    hosts += ["www." + h for h in hosts]
    near = [f"{n}s.example.com" for n in names] + [f"x{n}.com" for n in names]
    urls = [f"http://{h}{p}" for h in hosts + near for p in ("", "/", "/en/1", "/fr/2?x", "/q")]
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").write.parquet(f"{tmp_out}/pages.parquet")
    for r in E.queries()["op6_url_filter"](spark, tmp_out).collect():
        host, path, rule, verdict = brute(urls[r.page_id], U.RULES)
        want = verdict or ("block" if host in hosts else "allow")
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, want)


def test_no_page_of_a_bad_name_passes_without_a_rule(spark, sf_dir):
    import __spark_entry__ as E

    bad = E.queries()["op6_url_filter"](spark, sf_dir).filter("host rlike '(ads-track|adult-x|casino-win|cheap-pills|free-bets|spam-farm)'")
    assert bad.count() > 0 and bad.filter("rule is null and verdict = 'allow'").count() == 0
