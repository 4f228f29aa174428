import random
from collections import Counter

from pyspark.sql import functions as F

from tests.oracle import compare, connect
from tidegrid.llm import line_dedup as L
from tidegrid.llm import queries


def brute(rows, share=0.3, least=2):
    pages, having = Counter(), Counter()
    for host, lines in rows:
        pages[host] += 1
        having.update({(host, x) for x in lines or []})
    return [
        [x for x in lines or [] if not (having[host, x] >= least and having[host, x] > share * pages[host])]
        for host, lines in rows
    ]


def test_kept_lines_equal_brute_force(spark):
    rng = random.Random(0)
    rows = []
    for _ in range(400):
        host = rng.choice(["hot"] * 5 + ["a", "b", "c", None, ""])
        lines = [rng.choice(["home", "about", "©"]) for _ in range(rng.randrange(3))] + [f"x{rng.randrange(60)}" for _ in range(rng.randrange(5))]
        rows.append((host, rng.choice([lines, lines, None, []])))
    rows += [("one", ["alone", "alone"]), ("two", ["twice"]), ("two", ["twice"]), ("long", ["y" * 100_000] * 3)]
    numbered = [(i, h, ls, "extra", 1) for i, (h, ls) in enumerate(rows)]
    docs = spark.createDataFrame(numbered, "id long, site string, parts array<string>, host string, _drop int")
    got = L.drop_site_lines(docs, F.col("site"), F.col("parts"))
    assert got.columns == ["id", "site", "parts", "_drop", "host", "kept_lines", "n_lines"]
    by = {r.id: r for r in got.collect()}
    assert len(by) == len(rows)
    for i, kept in enumerate(brute(rows)):
        assert by[i].kept_lines == kept and by[i].n_lines == len(rows[i][1] or [])
    named = L.drop_site_lines(docs, F.col("site"), "parts")
    assert named.columns == got.columns and sorted(map(str, named.fillna("").collect())) == sorted(
        str(r) for r in got.withColumn("parts", F.coalesce("parts", F.array())).fillna("").collect()
    )
    assert L.drop_site_lines(docs.limit(0), F.col("site"), F.col("parts")).count() == 0


def test_hosts_and_lines(spark):
    urls = ["HTTP://User@A.Example.com:80/x?y", "https://b.org", "ftp://c/d#e", "no url", "", None]
    got = spark.createDataFrame([(u,) for u in urls], "u string").select(L.host_of(F.col("u")).alias("h")).collect()
    assert [r.h for r in got] == ["a.example.com", "b.org", "c", "", "", ""]
    html = ["<p>one <b>two</b></p>\n three <br>four<script>x</script><!-- c --><P class='k'>five", "", None, " \t\n", "<li> a </li><link x>b"]
    got = spark.createDataFrame([(h,) for h in html], "h string").select(L.html_lines(F.col("h")).alias("l")).collect()
    assert [r.l for r in got] == [["one two", "three", "four", "five"], [], [], [], ["a", "b"]]


def test_query_equals_its_sql_on_shared_hosts(spark, tmp_path):
    rng = random.Random(3)
    rows = [
        (i, f"https://{rng.choice(['a.org', 'b.org', 'B.org:8'])}/{i}", f"<p>top</p><div>{rng.randrange(9)}</div>\n<p>{'menu' if i % 2 else i}</p>")
        for i in range(60)
    ]
    rows += [(None, None, None), (7, "", "<p>"), (7, "", "<p>")]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/all")
    file = next((tmp_path / "all").glob("*.parquet"))
    file.rename(tmp_path / "pages.parquet")
    got = queries.line_dedup_query(spark, str(tmp_path))
    assert got.where("n_kept < n_lines").count() > 20
    con = connect("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet'")
    assert compare(got, con, queries.ORACLES["op9_line_dedup"]) is None
