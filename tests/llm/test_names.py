"""Columns named like the operators' own."""
from quarry.llm import decontaminate, line_dedup, simhash

OWN = ("__id", "__marks", "__m1", "__m2", "__mark", "__text", "__first")
LINE = " ".join(f"w{i}" for i in range(60))


def frame(spark):
    rows = [(1, LINE, *("a" * len(OWN))), (2, LINE, *("b" * len(OWN))), (3, "other words here", *("c" * len(OWN))), (None, None, *([None] * len(OWN)))]
    return spark.createDataFrame(rows, "__id long, __text string, " + ", ".join(f"{c} string" for c in OWN if c not in ("__id", "__text")) + ", x string, y string")


def test_line_dedup_and_near_dedup(spark):
    df = frame(spark)
    out = line_dedup.dedup_lines(df, id_col="__id", text_col="__text", passages=True)
    assert out.columns == df.columns
    got = {r["__id"]: (r["__text"], r["__marks"], r["__first"]) for r in out.collect()}
    assert got == {1: (LINE, "a", "a"), 2: ("", "b", "b"), 3: ("other words here", "c", "c"), None: (None, None, None)}
    kept = simhash.keep_one(df, id_col="__id", text_col="__text")
    assert kept.columns == df.columns and {(r["__id"], r["__mark"]) for r in kept.collect()} == {(1, "a"), (3, "c"), (None, None)}
    near = simhash.near_duplicates(df, id_col="__id", text_col="__text")
    assert {r["__id"]: r["component_id"] for r in near.collect()} == {1: 1, 2: 1, 3: 3, None: None}


def test_decontamination_with_one_id_name(spark):
    df = frame(spark)
    items = spark.createDataFrame([(7, LINE)], "__id long, text string")
    out = decontaminate.find_passages(df, items, id_col="__id", text_col="__text", item_id="__id")
    assert out.columns[:2] == ["__id", "item___id"]
    assert sorted((r["__id"], r["item___id"], r["distance"]) for r in out.collect()) == [(1, 7, 0), (2, 7, 0)]
    clean = decontaminate.drop_contaminated(df, items, text_col="__text", item_id="__id")
    assert clean.columns == df.columns and {r["__id"] for r in clean.collect()} == {3, None}
