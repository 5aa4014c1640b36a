"""Index rebuild: the newest landing counts, refreshes swap whole catalogues or nothing."""

from __future__ import annotations

import pytest

from gridtide.operators import rebuild

BASE = "https://figures.example.net"
PAGE = '<h1>{name}</h1><ul><li><a href="/{path}/{release}/{file}.xlsx">Table 4. {file} by port</a></li></ul>'


def page(number, path, name, release, file, landed):
    html = PAGE.format(name=name, path=path, release=release, file=file) if file else f"<h1>{name}</h1>"
    return number, f"{BASE}/{path}", html, landed


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, landed int")


def seeds(spark, *paths):
    rows = [(p.upper(), p, "about", f"{BASE}/{p}", "seed", f"{BASE}/{p}/may-2031/seed.xlsx", "seed.xlsx", "1", True, False)
            for p in paths]
    return spark.createDataFrame(rows, "cat_no string, title string, description string, page_url string, "
                                       "file_title string, url string, filename string, table_no string, "
                                       "is_timeseries boolean, is_cube boolean")


def stored(spark, store):
    return sorted((r["cat_no"], r["url"].rsplit("/", 1)[1]) for r in rebuild.stored_rows(spark, store).collect())


def test_newest_landings(spark):
    rows = [page(1, "a", "A", "jun-2031", "x", 1), page(2, "a", "A", "jun-2031", "y", 3),
            page(3, "a", "A", "jun-2031", "z", 3), page(4, "b", "B", "jun-2031", "w", 1)]
    found = rebuild.newest_landings(pages(spark, rows))
    assert sorted(r["page_id"] for r in found.collect()) == [3, 4]


def test_refresh(spark, tmp_path, monkeypatch):
    store = str(tmp_path / "store")
    assert rebuild.stored_rows(spark, store).count() == 0
    first = [page(1, "a", "A", "jun-2031", "old", 1), page(2, "a", "A", "jun-2031", "new", 2),
             page(3, "b", "B", "jun-2031", "bee", 1)]
    rebuild.refresh_index(spark, pages(spark, first), seeds(spark, "a", "b"), BASE, store)
    assert stored(spark, store) == [("A", "new.xlsx"), ("B", "bee.xlsx")]  # a page landed twice counts once
    later = [page(5, "a", "A", "jul-2031", "next", 3)]
    rebuild.refresh_index(spark, pages(spark, first + later), seeds(spark, "a"), BASE, store)
    assert stored(spark, store) == [("A", "next.xlsx"), ("B", "bee.xlsx")]
    releases = {(r["cat_no"], str(r["release_date"])) for r in rebuild.stored_rows(spark, store, "releases").collect()}
    assert ("A", "2031-07-01") in releases and ("A", "2031-06-01") not in releases
    last = [page(6, "b", "B", "aug-2031", "lost", 4)]
    with monkeypatch.context() as broken:
        broken.setattr(rebuild, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            rebuild.refresh_index(spark, pages(spark, first + last), seeds(spark, "b"), BASE, store)
    assert stored(spark, store) == [("A", "next.xlsx"), ("B", "bee.xlsx")]  # never seen
    rebuild.refresh_index(spark, pages(spark, first + last), seeds(spark, "b"), BASE, store)
    assert stored(spark, store) == [("A", "next.xlsx"), ("B", "lost.xlsx")]


def test_refresh_parses_pages_once(spark, tmp_path, monkeypatch):
    """Files and releases are read from the same outlines."""
    from gridtide.sources import pages as source

    store, parses, made = str(tmp_path / "store"), [], source._outlines
    monkeypatch.setattr(source, "_outlines", lambda contexts: parses.append(contexts) or made(contexts))
    rows = [page(1, "a", "A", "jun-2031", "x", 1), page(2, "a", "A", "jul-2031", "y", 2)]
    rebuild.refresh_index(spark, pages(spark, rows), seeds(spark, "a"), BASE, store)
    assert parses == [True]
    assert stored(spark, store) == [("A", "y.xlsx")]
    assert [str(r["release_date"]) for r in rebuild.stored_rows(spark, store, "releases").collect()] == ["2031-07-01"]
