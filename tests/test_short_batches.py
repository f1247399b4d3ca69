"""A map over batches gets and gives short ones."""

from tallyguard.operators import scoring


def test_a_map_gets_short_batches(spark):
    n = 3 * scoring.MAP_ROWS + 5
    out = scoring.batched_map(spark.range(n, numPartitions=1), lambda b: b.assign(size=len(b), first=b.index[0]),
                              "id long, size long, first long").toPandas()
    assert sorted(out["id"]) == list(range(n)) and out["size"].max() <= scoring.MAP_ROWS and (out["first"] == 0).all()
