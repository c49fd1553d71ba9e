"""Style trees of deep pages."""

from bramble.llm import html_extract


def test_content_below_twenty_constant_wrappers_stays(spark):
    for depth in (9, 20):
        rows = [(i, "http://deep.example/x", "<html><body><p>Same line</p>" + "<div>" * depth + f"<p>own text number {i}</p>" + "</div>" * depth
                 + "</body></html>") for i in range(12)]
        got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
        assert got == {i: f"own text number {i}" for i in range(12)}
