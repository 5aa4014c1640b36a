from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from gridtide.operators import catalogue, discovery
from gridtide.schemas import FILE_INDEX
from gridtide.sources import inventory, pages
from gridtide.sources.pages import page_outlines

D = datetime.date
BASE = "https://stats.example.org"


def file_row(cat, release, title, name, table="", cube=False):
    return (cat, f"Title {cat}", "About jobs", f"{BASE}/{cat}", release, title, f"{BASE}/{name}",
            name, "xlsx", table, title, not cube, cube)


@pytest.fixture(scope="module")
def index(spark):
    rows = [
        file_row("6202.0", "sep-2019", "Table 1. Old", "a.xlsx", "1"),
        file_row("6202.0", "apr-2026", "Table 2. New", "b.xlsx", "2"),
        file_row("6202.0", "apr-2026", "Table 1. New", "c.xlsx", "1"),
        file_row("6202.0", "apr-2026", "Labelled matrix", "d.xlsx", "", True),
        file_row("6202.0", "apr-2026", "Gross flows cube", "e.xlsx", "", True),
        file_row("6401.0", "mar-2024", "All groups", "f.xlsx", "7"),
    ]
    return spark.createDataFrame(rows, FILE_INDEX)


def names(df):
    return sorted(r["filename"] for r in df.collect())


def test_filters_and_search(index):
    assert names(catalogue.files(index, " 6401.0 ")) == ["f.xlsx"]
    assert len(names(catalogue.files(index))) == 6
    assert names(catalogue.search_index(index, "JOBS Labelled")) == ["d.xlsx"]
    assert len(names(catalogue.search_index(index, " "))) == 6
    assert names(catalogue.cube_files(index, "6202.0", "APR-2026")) == ["d.xlsx", "e.xlsx"]
    assert names(catalogue.cube_files(index, "6202.0", D(2026, 4, 1))) == ["d.xlsx", "e.xlsx"]
    assert names(catalogue.search_cubes(index, "org/e.", "6202.0")) == ["e.xlsx"]
    assert names(catalogue.cube_files(index, release="none")) == []
    with pytest.raises(ValueError):
        catalogue.cube_files(index, release=D(2024, 3, 1))


def test_catalogues(index):
    rows = catalogue.catalogues(index, ["filename"]).orderBy("cat_no").collect()
    assert [(r["cat_no"], r["supported"]) for r in rows] == [("6202.0", True), ("6401.0", True)]


def test_selection(spark, index):
    cases = [
        (1, "6202.0", None, None, False, "c.xlsx", None),
        (2, "6202.0", "table 2", None, False, "b.xlsx", None),
        (3, "6202.0", "1", "sep-2019", False, "a.xlsx", None),
        (4, "6202.0", None, "SEP-2019", False, "a.xlsx", None),
        (5, "6202.0", None, None, True, "d.xlsx", None),
        (6, "6202.0", "gross", None, True, "e.xlsx", None),
        (7, "6401.0", None, None, True, None, "no files of this kind"),
        (8, "6202.0", "missing", None, False, None, "no file matched"),
        (9, "6202.0", None, "jan-1901", False, None, "no files for release"),
        (10, "0000.0", None, None, False, None, "no files for catalogue"),
        (11, "6401.0", None, None, False, "f.xlsx", None),
    ]
    requests = spark.createDataFrame(
        [c[:5] for c in cases],
        "request_id int, cat_no string, file string, release string, cube boolean")
    rows = catalogue.select_files(index, requests).collect()
    got = {r["request_id"]: (r["filename"], r["error"]) for r in rows}
    assert got == {c[0]: c[5:] for c in cases}


def test_families(index):
    assert names(catalogue.family_files(index, "lfs_grossflows")) == ["e.xlsx"]
    assert names(catalogue.family_files(index, "lfs_cube", "labelled")) == ["d.xlsx"]
    assert names(catalogue.family_files(index, "cpi")) == ["f.xlsx"]
    with pytest.raises(ValueError):
        catalogue.family_files(index, "gdp")


def test_releases(spark, index):
    known = spark.createDataFrame(
        [("1", D(2033, 3, 5)), ("1", D(2033, 3, 28)), ("1", D(2033, 5, 1)), ("1", D(2034, 1, 9)), ("1", D(2033, 3, 28))],
        "cat_no string, release_date date")
    asked = spark.createDataFrame([("1", D(2033, 3, 27)), ("2", D(2033, 3, 27))], "cat_no string, requested date")
    near = catalogue.nearest_releases(asked, known).orderBy("rank").collect()
    assert [(r["release_date"], r["days"]) for r in near] == [
        (D(2033, 3, 28), 1), (D(2033, 3, 5), 22), (D(2033, 5, 1), 35)]
    tied = spark.createDataFrame([("1", D(2033, 4, 14))], "cat_no string, requested date")
    near = catalogue.nearest_releases(tied, known, k=2).orderBy("rank").collect()
    assert [r["release_date"] for r in near] == [D(2033, 3, 28), D(2033, 5, 1)]
    wanted = spark.createDataFrame([("6202.0", D(2019, 9, 1))], "cat_no string, release_month date")
    assert names(catalogue.release_files(index, wanted)) == ["a.xlsx"]


def test_index_store(spark, index, tmp_path):
    path = str(tmp_path / "index")
    inventory.write_index(index, path)
    newer = index.where("cat_no = '6401.0'").withColumn("title", F.lit("New"))
    inventory.write_index(newer, path)
    stored = inventory.read_stored_index(spark, path)
    assert stored.count() == 6 and stored.where("title = 'New'").count() == 1
    older = tmp_path / "older.json"
    older.write_text('[{"cat_no": "7710.0", "file_title": "Table 12. Buoys by bay", "is_cube": true, "unknown": 1}]')
    row = inventory.read_index(spark, str(older)).first()
    assert (row["table_title"], row["is_cube"], row["filename"]) == ("Table 12. Buoys by bay", True, None)
    dated = tmp_path / "releases.json"
    dated.write_text('[{"cat_no": "1", "release_date": "oct-2037"}, {"cat_no": "2", "release_date": "2037-10-04"}]')
    assert [(r["cat_no"], r["release_date"]) for r in inventory.read_releases(spark, str(dated)).collect()] == [
        ("2", D(2037, 10, 4))]
    found = inventory.stored_files(spark, str(tmp_path)).collect()
    assert {"index", "other"} == {r["kind"] for r in found}


BUOYS = f"{BASE}/sea/buoys"
# A page of an invented sea office: one file in a list, two in a table of definitions, one bare.
PUBLICATION = """
<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><meta name="description" content="All buoys of the bay">
<title>Sea office</title></head><body><main><h1>Buoys</h1>
<table class="files"><tr><th>What</th><th>File</th></tr>
<tr><td>Table 4. Buoys by colour and bay</td><td><a href="/sea/buoys/nov-2036/77100004.xlsx">Download xlsx [12 KB]</a></td></tr>
<tr><td>Table 9. Lights by age</td><td><a href="/sea/buoys/nov-2036/77100009.xlsx">Download xlsx [9.5 KB]</a></td></tr>
<tr><td>Table 9. Lights by age</td><td><a href="/sea/buoys/nov-2036/77100009.xlsx?from=list">Download xlsx [9.5 KB]</a></td></tr>
</table>
<ul><li>Drift of buoys data cube <a href="//stats.example.org/sea/buoys/nov-2036/drift.CSV?v=3#top">csv</a></li></ul>
<p>See also <a href="/store/77100015.xlsx">Download</a></p></main>
<div><a href="/sea/buoys/older">Past releases</a></div>
</body></html>"""
OLDER = """<h1>Older</h1><ol><li><a href="/sea/buoys/feb-2031">February 2031</a></li>
<li><a href="/sea/buoys/may-2032">May 2032</a></li>
<li><a href="/sea/buoys/may-2032?ref=list">Buoys,&nbsp;May 2032</a></li>
<li><a href="/sea/other/jun-2032">Elsewhere</a></li></ol>"""
TIDES = '<h1>Tide Tables</h1><p><a href="/tides/apr-2037">Tide Tables and Times April 2037</a></p>'
TIDES_ISSUE = '<section><p>Table 16. High water <a href="/tides/apr-2037/high.xlsx">get xlsx</a></p></section>'


@pytest.fixture(scope="module")
def site(spark):
    landed = spark.createDataFrame(
        [(11, BUOYS, PUBLICATION), (12, BUOYS + "/older", OLDER), (13, BASE + "/tides", TIDES),
         (14, BASE + "/tides/apr-2037", TIDES_ISSUE)],
        "page_id bigint, url string, html string")

    def seed(cat_no, title, page, url):
        return (cat_no, title, "From the seed", page, "Seeded", url, "seeded.xlsx", "3", True, False)

    seeds = spark.createDataFrame(
        [seed("7710.0", "Buoys of the bay", BUOYS, BUOYS + "/aug-2036/y.xlsx"),
         seed("7720.0", "Tide Tables and Times", BASE + "/tides", BASE + "/tides/mar-2037/t.xlsx"),
         seed("7730.0", "No dates", BASE + "/wrecks", BASE + "/wrecks/list.xlsx")],
        "cat_no string, title string, description string, page_url string, file_title string, "
        "url string, filename string, table_no string, is_timeseries boolean, is_cube boolean")
    return landed, seeds


def test_discover_files(site):
    found = discovery.discover_files(*site, BASE).toPandas().set_index("url")
    buoys = found[found["cat_no"] == "7710.0"]
    assert len(buoys) == 4 and set(buoys["title"]) == {"Buoys"}
    assert set(buoys["description"]) == {"All buoys of the bay"}
    nine = buoys.loc[BUOYS + "/nov-2036/77100009.xlsx"]
    assert (nine["file_title"], nine["table_no"], nine["release_date"]) == (
        "Table 9. Lights by age", "9", "nov-2036")
    cube = buoys.loc[BUOYS + "/nov-2036/drift.CSV"]
    assert cube["is_cube"] and cube["file_type"] == "csv" and cube["table_no"] == ""
    assert cube["table_title"] == "Drift of buoys data cube"
    bare = buoys.loc[BASE + "/store/77100015.xlsx"]
    assert (bare["table_no"], bare["release_date"]) == ("15", "aug-2036")
    tides = found[found["cat_no"] == "7720.0"].iloc[0]
    assert (tides["title"], tides["table_no"], tides["release_date"]) == ("Tide Tables", "16", "apr-2037")
    assert found[found["cat_no"] == "7730.0"].iloc[0]["filename"] == "seeded.xlsx"


def test_discover_releases(site):
    found = discovery.discover_releases(*site, BASE).toPandas()
    buoys = found[found["cat_no"] == "7710.0"]
    pages_only = buoys[~buoys["release_url"].str.contains("xlsx|CSV")].sort_values("release_date")
    assert list(pages_only["release_date"]) == [D(2031, 2, 1), D(2032, 5, 1)]
    assert list(pages_only["title"]) == ["February 2031", "Buoys, May 2032"]
    undated = found[found["cat_no"] == "7730.0"].iloc[0]
    assert (undated["release_date"], undated["release_url"]) == (D(1, 1, 1), BASE + "/wrecks")


def test_files_of_release(spark, site):
    landed, seeds = site
    releases = spark.createDataFrame(
        [("7720.0", "", D(2037, 4, 1), BASE + "/tides/apr-2037"),
         ("7720.0", "", D(2037, 5, 1), BASE + "/tides/apr-2037")],
        "cat_no string, title string, release_date date, release_url string")
    found = discovery.files_of_release(landed, releases, seeds, BASE).collect()
    assert [(r["release_date"], r["title"]) for r in found] == [("apr-2037", "Tide Tables and Times")]


def test_release_rows_without_catalogue(spark, site):
    links = spark.createDataFrame([(1, "/sea/buoys/feb-2031", "x"), (2, "/else/feb-2031", "y")],
                                  "ord int, href string, label string")
    found = discovery.release_rows(links, site[1], BASE).collect()
    assert [(r["cat_no"], r["release_date"]) for r in found] == [("7710.0", D(2031, 2, 1))]


def test_unclosed_elements(spark):
    html = "<ul><li>one <a href='a.xlsx'>x</a><li>two <a href='b.xlsx'>y</a></ul><p>three<p>four"
    landed = spark.createDataFrame([(1, html), (2, None)], "page_id bigint, html string")
    outline = page_outlines(landed).orderBy("page_id").first()
    assert [(c["selector"], c["text"].strip()) for c in outline["contexts"]] == [(1, "one x"), (1, "two y")]
    links = pages.page_links(landed).collect()
    assert [(r["ord"], r["href"], r["label"]) for r in links] == [(1, "a.xlsx", "x"), (2, "b.xlsx", "y")]


def test_shared_context_only_fills_gaps(spark):
    html = ("<article><p>Short <a href='a.xlsx'>get</a></p>Both <a href='b.xlsx'>b</a></article>"
            "<section>Table 1. Better <a href='a.xlsx'>again</a></section>")
    landed = spark.createDataFrame([(1, html)], "page_id bigint, html string")
    got = {r["url"]: r["context"] for r in
           discovery.link_contexts(page_outlines(landed), BASE).collect()}
    assert got == {BASE + "/a.xlsx": "Table 1. Better again", BASE + "/b.xlsx": "Short getBoth b"}


def test_unknown_catalogues(spark, site):
    asked = spark.createDataFrame([("7720.0",), ("1.0",)], "cat_no string")
    assert [r["cat_no"] for r in catalogue.unknown_catalogues(asked, site[1]).collect()] == ["1.0"]


def test_texts_are_searched_once(spark, site):
    """Patterns of a row come a few times in a plan, not once for each place that names the text."""
    links = spark.createDataFrame([("7710.0", 1, "/sea/buoys/feb-2031", "x")],
                                  "cat_no string, ord int, href string, label string")
    releases = discovery.release_rows(links, site[1], BASE)
    facts = ["cat_no", "title", "description", "page_url", "seed_url", "url", "label", "context"]
    downloads = spark.createDataFrame([(0, 1, *facts)], ["page_key", "ord", *facts])
    for found, pattern, most in ((releases, "(jan|feb", 8), (discovery.file_rows(downloads), "[^\\w.\\-]+", 5)):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert 0 < plan.count(pattern) <= most


def test_plain_tags_read_as_by_the_parser():
    """Pages are outlined alike whether their plain tags are told apart first or not."""
    odd = ["<!-- <p> -->", "<!doctype html>", "<script>'<li>'</script>", "<title>a &lt</title>", "<a href='b.csv'>",
           "<br/>", "</p x>", "<a\x0bhref=\"c.xls\">", "&am", "< ", "<a href=\"un"]
    plain = ("<META name=\"Description\" content=\"1 &lt; 2\"><h1>A &amp; B</h1><p>one<section class=\"x downloads\">"
             "<table><tr><td>t<td><A HREF=\"a.xls?x=1&amp;y\" href=\"no\">get</a>\xa0</table></section>"
             "<a class=\"download\" href=\"d.csv\">d</a><li>two")
    for text in [plain, *[plain + x + plain for x in odd], *[x + plain for x in odd]]:
        fast, slow = pages._Outline(True), pages._Outline(True)
        fast.read(text)
        slow.feed(text)
        slow.read("")  # nothing but the end
        assert (fast.h1, fast.description, fast.links, fast.contexts) == (
            slow.h1, slow.description, slow.links, slow.contexts)
        assert fast.links and (text != plain or (fast.h1, fast.description) == ("A & B", "1 < 2"))
