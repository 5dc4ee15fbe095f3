"""Queries read all of their columns and rows."""

from checks import learning
from meterline.learn import clusters, prep
from meterline.schemas import numeric_columns


def test_the_mixture_elbow_reads_all_columns(spark, sf_dir, monkeypatch):
    seen = []

    def elbow(df, mixture):
        seen.append((mixture, df.first()["features"].size))
        return spark.createDataFrame([(2, 0.0)], "k int, cost double")

    monkeypatch.setattr(clusters, "elbow", elbow)
    learning.ENTRIES["U4_elbow_bic"][0](spark, sf_dir).collect()
    columns = numeric_columns(prep.cluster_set(learning.usable(spark, sf_dir)))
    assert len(columns) > len(learning.FEW) and seen == [(True, len(columns))]
