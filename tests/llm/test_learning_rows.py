"""What the fit of the toxicity model moves."""

from pyspark.sql import functions as F

from barlake.llm import queries, toxicity

FOLDER = "/root/testdata/sf0.001"


def test_counting_learning_rows_moves_no_text(spark, monkeypatch):
    """Over labels too large for a broadcast, the count shuffled every text before."""
    seen = {}
    fit = toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda learning: (seen.update(rows=learning), fit(learning))[1])
    queries.QUERIES["op8_toxicity"](spark, FOLDER)
    rows = seen["rows"]
    size = "text_bytes" if "text_bytes" in rows.columns else F.octet_length("text")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = rows.select(size).agg(F.sum(rows.select(size).columns[0]))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    scan, moved = plan.split("Exchange hashpartitioning(doc_id", 1)[1].split("FileScan")[0], plan.split("Exchange hashpartitioning")[0]
    assert "octet_length" in scan and "octet_length" not in moved


def test_sizes_from_before_the_join_give_the_same_model(spark):
    docs = spark.createDataFrame([(i, None if i == 3 else f"you idiot {i} " * (i % 5)) for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2 if i % 7 else None) for i in range(0, 220, 2)], "doc_id long, toxic int")
    sized = toxicity.learning_rows(docs, labels)
    plain = docs.join(labels, "doc_id")
    for sample in (10_000, 40):
        a, b = toxicity.fit(sized, sample), toxicity.fit(plain, sample)
        assert (a.lexicon == b.lexicon).all() and (a.vote_weights == b.vote_weights).all() and a.intercept == b.intercept
