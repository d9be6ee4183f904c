"""The layout queries read documents of any length to their end."""

import pytest

from workload.queries import QUERIES

LONG = "\n".join(f"line {i} with <b>signs</b> & &lt;entities&gt; </div> " + "word " * 20 for i in range(300))
TEXTS = [LONG, "short", "two\r\n \n\tlines ", LONG + " end"]


def lines(text):
    return [x for x in (line.strip(" \t\r") for line in text.split("\n")) if x]


@pytest.mark.parametrize("name, end", [("first_layout_whole", ["x", "y", "end"]), ("second_layout_whole", ["end"])])
def test_whole_texts_pass_through_the_layouts(spark, tmp_path, name, end):
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, f"u{i}") for i in range(len(TEXTS))], "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    found = {r.page_id: r for r in QUERIES[name](spark, str(tmp_path)).collect()}
    assert len(found) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        assert found[i].description.split("\n") == lines(text) + end
        assert found[i].requirements.split("\n") == ["start"] + lines(text)
