from tillroll.llm import reputation


def table(spark, rows):
    return spark.createDataFrame([(i, u, "x", "y") for i, u in rows], "page_id long, url string, host string, fit string")


def judged(spark, rows, labels):
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return {r["page_id"]: tuple(r)[1:] for r in reputation.judge(table(spark, rows), marks).collect()}


def test_rules_and_parts(spark):
    rows = [(1, "http://WWW.Example.com/en/x?q#f"), (2, "https://example.com/en/"), (3, "https://a.example.com/en"),
            (4, "http://notexample.com"), (5, "ftp://b.net/es/1"), (6, "http://net/fr/"), (7, "http://x.net/de/"), (8, None),
            (9, "no scheme/en/"), (10, "http://"), (11, "http://É.Org/p\nq?x"), (12, "a://b://c/d"), (13, "http://h.com?x/en/")]
    out = judged(spark, rows, [])
    assert out[1] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert out[2] == ("example.com", "/en/", "example.com/en/", "block")
    assert out[3] == ("a.example.com", "/en", "com/", "allow")
    assert out[4] == ("notexample.com", "", None, "allow") or out[4][2] is None
    assert out[5][2:] == ("net/es/", "block") and out[6][2:] == ("net/fr/", "block") and out[7][2] is None
    assert out[8][:3] == ("", "", None) and out[9][:3] == ("", "", None) and out[10][:3] == ("", "", None)
    assert out[11][:2] == ("É.org", "/p\nq") and out[12][:2] == ("b:", "//c/d") and out[13][:2] == ("h.com", "")


def test_reputation_follows_outcomes_up_the_levels(spark):
    rows, labels, i = [], [], 0
    for host, n, bad in (("bad.evil.org", 60, 50), ("good.fine.org", 200, 2), ("new.evil.org", 3, None), ("new.fine.org", 3, None),
                         ("one.fine.org", 1, 1), ("other.evil.org", 60, 45)):
        for k in range(n):
            rows.append((i, f"http://{host}/{k}"))
            if bad is not None:
                labels.append((i, 1, int(k < bad)))
            i += 1
    out = judged(spark, rows + [(None, "http://good.fine.org/z")], labels + [(None, 0, 1), (2, None, None), (3, 1, 1)])
    verdict = {v[0]: v[3] for v in out.values()}
    assert verdict["bad.evil.org"] == verdict["other.evil.org"] == "block"
    assert verdict["good.fine.org"] == verdict["new.fine.org"] == verdict["one.fine.org"] == "allow"


def test_repeated_rows_and_empty_tables(spark):
    marks = spark.createDataFrame([(1, 0, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    assert reputation.judge(table(spark, [(1, "http://a.org/")] * 3), marks).count() == 3
    assert reputation.judge(table(spark, []), marks).collect() == []
