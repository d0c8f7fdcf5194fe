"""Page queries over addresses that were landed twice."""

from gridlore.plans import page_queries
from gridlore.session import new_path

HTML = '<ul><li><a href="{}">x</a></li></ul>'


def landed(spark, pages):
    folder = new_path(spark, "pages-folder")
    spark.createDataFrame([(i, u, HTML.format(h)) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string").write.parquet(
        f"{folder}/pages.parquet")
    return folder


def test_a_page_landed_twice_does_not_cut_its_listing(spark, rows):
    names = ["http://a.b/en/1", "http://a.b/en/2", "http://a.b/en/3"]
    folder = landed(spark, [(u, "/none") for u in [*names, names[1], names[1]]])
    whole = [(names[0], i, u, "fin" if i == 2 else None) for i, u in enumerate(names)]
    assert rows(page_queries.page_chains_whole(spark, folder)) == whole
    assert rows(page_queries.page_chains(spark, folder)) == whole


def test_markup_chains_hold_a_page_once(spark, rows):
    folder = landed(spark, [("http://a.b/1", "/2"), ("http://a.b/1", "/2"), ("http://a.b/2", "/9")])
    assert rows(page_queries.page_chains_markup(spark, folder)) == [
        ("http://a.b/1", 0, "http://a.b/1", None), ("http://a.b/1", 1, "http://a.b/2", "ausente")]
