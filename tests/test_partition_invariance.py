"""SURVEY §5(d): the same result under 1, 4 and 17 partitions."""
from pyspark.sql import functions as F

from quarry.operators import metrics as E
from quarry.operators import profile as P
from quarry.operators import text as TX
from quarry.operators.split import kfold
from quarry.sources.tables import dl_view, table
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_operators_do_not_depend_on_partitioning(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    li = table(spark, SF_SMALL, "lineitem")
    dl = dl_view(spark, SF_SMALL)
    results = []
    for n in (1, 4, 17):
        wc = TX.word_counts(docs.repartition(n), "doc_id", "text")
        q = P.exact_quantiles(li.repartition(n), "l_extendedprice", [0.1, 0.5, 0.9],
                              ["l_returnflag"])
        f = kfold(li.select("l_orderkey", "l_linenumber", "l_partkey").repartition(n), 5,
                  ["l_orderkey", "l_linenumber", "l_partkey"], portable=True)
        auc = E.roc_auc(dl.repartition(n), "distinct_share", "quality")
        results.append((_rows(wc), _rows(q), _rows(f), round(auc.first()[0], 12)))
    assert results[0] == results[1] == results[2]
