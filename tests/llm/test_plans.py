"""What the joins of the corpus operators send through the driver."""

from spliceloom.llm import spelling


def test_spelling_joins_broadcast_no_words(spark):
    """A small file of words can make index entries of many times its bytes, so no join may trust Spark's size of them."""
    table = spark.createDataFrame([("schreiben", 9), ("schriben", 2), ("zeichnen", 4), ("zeichnnen", 1)], "word string, n long")
    for df in (spelling.near_words(table), spelling.spelling_groups(table)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Join" in plan and "Broadcast" not in plan
    got = {r["word"]: r["form"] for r in spelling.spelling_groups(table).collect()}
    assert got == {"schreiben": None, "schriben": "schreiben", "zeichnen": None, "zeichnnen": "zeichnen"}
