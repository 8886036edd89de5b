"""Numbers by key in sorted arrays, over several shards."""

import numpy as np

from tallyrow.functions import numbers


def test_every_key_is_found_in_its_shard(spark):
    rows = spark.range(-500, 500).selectExpr("id * 3 as k", "id as a", "-id as b").repartition(7)
    table = numbers.write_numbers(rows, "k", ["a", "b"], 1000, "numbers", shard_keys=90)
    assert table.shards > 10 and len(table.held) == table.shards
    keys = np.arange(-1600, 1600)
    known, found = table.get(keys)
    inside = (keys % 3 == 0) & (keys >= -1500) & (keys < 1500)
    assert (known == inside).all() and (found[inside] == np.stack([keys, -keys], axis=1)[inside] // 3).all() and not found[~inside].any()


def test_an_empty_table_holds_nothing(spark):
    table = numbers.write_numbers(spark.range(0).selectExpr("id as k", "id as a"), "k", ["a"], 0, "numbers")
    known, found = table.get(np.asarray([0, 1]))
    assert table.held == () and not known.any() and found.shape == (2, 1)
