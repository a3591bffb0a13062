"""Small tables with hand-checked expected values (FIXTURES.md)."""

from pyspark.sql import functions as F

TRAIN_SCHEMA = (
    "id BIGINT, contract STRING, internet STRING, payment STRING, senior INT, tenure INT, "
    "monthly DOUBLE, total STRING, churn STRING, fold INT"
)
TRAIN = [
    (1, "M", "Fiber", "Electronic check", 0, 0, 70.0, " ", "Yes", 0),
    (2, "M", "DSL", "Mailed check", 0, 3, 30.0, "95.5", "No", 1),
    (3, "M", "Fiber", "Bank (Automatic)", 1, 12, 90.0, "1080", "1", 0),
    (4, "1Y", "No", "Mailed check", 0, 24, 20.0, "480", "0", 1),
    (5, "1Y", None, "Credit card (automatic)", 0, 72, 95.0, "6800", "1.0", 0),
    (6, "2Y", "DSL", None, 0, 999, 50.0, "abc", "No", 1),
    (7, None, "Fiber", "Electronic check", 1, 6, 80.0, "480", None, 0),
    (8, "M", "No", "Mailed check", 0, 1000, 20.0, "20", "0", 1),
]
TEST = [
    (101, "M", "DSL", "Electronic check", 0, 5, 35.0, "170"),
    (102, "3Y", "No", "Mailed check", 0, 12, 20.0, "240"),
    (103, None, None, None, 1, 0, 70.0, None),
]
SCORES = {
    "a": [0.9, 0.2, 0.3, 0.2, 0.7, 0.4, 0.4, 0.1],
    "b": [0.5, 0.5, 0.8, 0.3, 0.3, 0.6, 0.1, 0.1],
    "c": [0.4, 0.9, 0.7, 0.3, 0.2, 0.2, 0.5, 0.3],
}
LABELS = [1, 0, 1, 0, 1, 0, 0, 0]


def both(spark):
    """Training and test rows as one tagged table with a numeric target."""
    from tabloom.operators.clean import coerce_numeric, normalise_target

    train = normalise_target(spark.createDataFrame(TRAIN, TRAIN_SCHEMA), "churn", out="y")
    test_schema = TRAIN_SCHEMA.split(", churn")[0]
    test = spark.createDataFrame(TEST, test_schema)
    whole = train.withColumn("split", F.lit("train")).unionByName(
        test.withColumn("split", F.lit("test")), allowMissingColumns=True
    )
    return coerce_numeric(whole.drop("churn"), ["total"])


def column(df, name, key="id"):
    """{key: value} of a column, rounded."""
    return {
        r[key]: round(r[name], 6) if isinstance(r[name], float) else r[name]
        for r in df.select(key, name).collect()
    }


def long_scores(spark):
    rows = [
        (i + 1, model, "train", label, score)
        for model, values in SCORES.items()
        for i, (label, score) in enumerate(zip(LABELS, values))
    ]
    return spark.createDataFrame(
        rows, "id BIGINT, model STRING, split STRING, label INT, score DOUBLE"
    )
