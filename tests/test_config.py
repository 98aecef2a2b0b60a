"""Session settings and the scratch folder."""

from __future__ import annotations

import pytest

from millwright.config import cluster_settings, scratch_dir
from millwright.sources.tables import materialize


@pytest.mark.parametrize("size, partitions", [
    (0, "200"), (2**40, "5242"), (100 * 10**12, "476837")])
def test_shuffle_partitions_follow_the_input(spark, size, partitions):
    settings = cluster_settings(size)
    assert settings["spark.sql.shuffle.partitions"] == partitions
    for key in settings:
        assert spark.conf.isModifiable(key), key


def test_scratch_is_the_folder_the_session_names(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert configured in scratch_dir(spark)
    kept = materialize(spark.range(5).selectExpr("id", "cast(id as string) as text"), "kept")
    assert all(configured in f for f in kept.inputFiles())
    assert kept.count() == 5
