import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyrow.functions.ordering import keys_at, with_ordinal, with_shuffled_position
from tallyrow.operators import batching, slices
from tallyrow.operators.slices import slice_rows, slice_spec, train_val_split
from tallyrow.sources.tables import read_instructions, select_split


@pytest.fixture(scope="module")
def ten(spark):
    return spark.createDataFrame([(k, f"t{k}") for k in (7, 3, 9, 0, 5, 1, 8, 2, 6, 4)], "k bigint, t string").repartition(3)


@pytest.fixture(scope="module")
def skewed(spark):
    """Composite keys; one value of the first column holds most rows."""
    rows = [(1, i) for i in range(400)] + [(c, i) for c in (0, 2, 3) for i in range(30)]
    return spark.createDataFrame(rows, "c bigint, i bigint").repartition(5)


def ks(df):
    return sorted(r.k for r in df.collect())


@pytest.mark.parametrize(
    "spec, expected",
    [
        ("train", range(10)),
        ("train[:3]", range(3)),
        ("train[3:5]", range(3, 5)),
        ("train[8:20]", range(8, 10)),
        ("train[12:20]", []),
        ("train[5:5]", []),
        ("train[7:]", range(7, 10)),
        ("train[:0]", []),
        ("train[:]", range(10)),
        ("train[:10%]", range(1)),
        ("train[:25%]", range(2)),  # 2.5 rounds to even
        ("train[:35%]", range(4)),  # 3.5 rounds to even
        ("train[20%:50%]", range(2, 5)),
        ("train[:200%]", range(10)),
    ],
)
def test_slice_specs(ten, spec, expected):
    assert ks(slice_spec(ten, spec, "k")) == list(expected)


@pytest.mark.parametrize("spec", ["train[-3:]", "train[a:b]", "train[3]", "[:3]", ""])
def test_unreadable_specs(ten, spec):
    with pytest.raises(ValueError):
        slice_spec(ten, spec, "k")


def test_strict_bounds(ten):
    assert ks(slice_rows(ten, "k", 8, 10, strict=True)) == [8, 9]
    for start, stop in [(8, 20), (0, 11), (11, 12)]:
        with pytest.raises(ValueError):
            slice_rows(ten, "k", start, stop, strict=True)


def test_a_key_is_required(ten):
    with pytest.raises(ValueError):
        slice_rows(ten, [], 0, 3)


@settings(max_examples=12, deadline=None)
@given(start=st.integers(0, 14), stop=st.one_of(st.none(), st.integers(0, 14)), limit=st.sampled_from([2, 100]))
def test_slices_are_python_slices(ten, start, stop, limit):
    assert ks(slice_rows(ten, "k", start, stop, direct_limit=limit)) == list(range(10))[start:stop]


def test_head_and_tail_are_disjoint_and_complete(skewed):
    head, tail = slice_rows(skewed, ["c", "i"], 0, 123), slice_rows(skewed, ["c", "i"], 123)
    assert head.count() == 123 and tail.count() == 367
    assert head.intersect(tail).count() == 0


@pytest.mark.parametrize("position", [0, 5, 29, 30, 31, 211, 429, 430, 489, 490, 600])
def test_narrowing_finds_the_same_keys(skewed, position):
    """A limit of 5 forces the range narrowing that far positions take."""
    keys = sorted((r.c, r.i) for r in skewed.collect())
    found = keys_at(skewed, ["c", "i"], [position], direct_limit=5)
    assert found == ({position: keys[position]} if position < len(keys) else {})


def test_far_slices_by_narrowing(skewed):
    keys = sorted((r.c, r.i) for r in skewed.collect())
    rows = slice_rows(skewed, ["c", "i"], 100, 450, direct_limit=5).collect()
    assert sorted((r.c, r.i) for r in rows) == keys[100:450]


def test_bounds_reach_the_scan(spark, skewed, tmp_path, conf):
    conf(spark__sql__maxMetadataStringLength="10000")
    skewed.write.parquet(str(tmp_path / "t"))
    sliced = slice_rows(spark.read.parquet(str(tmp_path / "t")), ["c", "i"], 10, 20)
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "LessThanOrEqual(c," in plan and "GreaterThanOrEqual(c," in plan
    assert "Exchange" not in plan and "Sort" not in plan


def test_train_validation(ten):
    rows = {r.k: r.split for r in train_val_split(ten, "k", 4, 3).collect()}
    assert rows == {**dict.fromkeys(range(4), "train"), **dict.fromkeys(range(4, 7), "validation")}


@pytest.mark.parametrize("n_train, n_val, sizes", [(4, 99, (4, 6)), (99, 5, (10, 0)), (10, 5, (10, 0))])
def test_train_validation_past_the_end(ten, n_train, n_val, sizes):
    split = train_val_split(ten, "k", n_train, n_val)
    assert (select_split(split, "train").count(), select_split(split, "validation").count()) == sizes


def test_spec_name_picks_the_split(ten):
    split = train_val_split(ten, "k", 4, 3)
    assert ks(slice_spec(split, "validation[:2]", "k")) == [4, 5]


def test_split_folders_are_pruned(spark, ten, tmp_path):
    path = str(tmp_path / "by-split")
    train_val_split(ten, "k", 4, 3).write.partitionBy("split").parquet(path)
    rows = read_instructions(spark, path, split="validation", schema="k bigint, t string")
    assert ks(rows) == [4, 5, 6]
    assert "PartitionFilters: [isnotnull(split" in rows._jdf.queryExecution().executedPlan().toString()


def test_ordinal_of_a_hot_first_key(skewed):
    keys = sorted((r.c, r.i) for r in skewed.collect())
    rows = with_ordinal(skewed.selectExpr("*", "c * 1000 + i as v"), ["c", "i"]).collect()
    assert {(r.c, r.i): r.ordinal for r in rows} == {k: n for n, k in enumerate(keys)}
    assert all(r.v == r.c * 1000 + r.i for r in rows)


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_ordinal_does_not_depend_on_the_ranges(ten, partitions):
    assert all(r.k == r.ordinal for r in with_ordinal(ten, "k", partitions=partitions).collect())


def test_ordinal_of_bare_keys(ten):
    assert {r.k: r.ordinal for r in with_ordinal(ten.select("k"), "k").collect()} == {k: k for k in range(10)}


@pytest.mark.parametrize("digits", [1, 2, 5])
def test_shuffled_position_is_the_digest_order(skewed, digits):
    import hashlib

    keys = [(r.c, r.i) for r in skewed.collect()]
    order = sorted(keys, key=lambda k: (hashlib.md5(f"7:{k[0]}:{k[1]}".encode()).hexdigest(), k))
    rows = with_shuffled_position(skewed, ["c", "i"], 7, bucket_digits=digits).collect()
    assert {(r.c, r.i): r.position for r in rows} == {k: n for n, k in enumerate(order)}


@pytest.mark.parametrize("keys", [[None, None, None], [1, 1, 1, 2], [1, None]])
def test_rows_without_a_key_of_their_own_are_refused(spark, keys):
    df = spark.createDataFrame([(k, "x") for k in keys], "k long, v string")
    for use in (
        lambda: with_ordinal(df, "k"),
        lambda: slices.slice_rows(df, "k", 0, 2),
        lambda: slices.slice_spec(df, "train[:50%]", "k"),
        lambda: slices.train_val_split(df, "k", 1, 1),
    ):
        with pytest.raises(ValueError, match="rows without one"):
            use()
    with pytest.raises(ValueError):
        with_ordinal(df.selectExpr("k", "1 as j"), ["j", "k"])


def test_split_by_share_keeps_every_row(spark):
    df = spark.range(0, 11).toDF("k")
    got = {r.k: r.split for r in slices.split_by_share(df, "k", 75).collect()}
    assert got == {i: "train" if i < 8 else "validation" for i in range(11)}


def test_a_head_shuffles_no_key(spark, tmp_path):
    """Only each task's first keys leave it: the plan of the one job over keys has no hash exchange."""
    spark.range(3000).selectExpr("id as k", "id % 7 as v").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    assert sorted(r.k for r in slices.slice_rows(df, "k", 0, 5).collect()) == list(range(5))
    assert slices.slice_rows(df, "k", 0, 5000).count() == 3000
    head = df.select("k").orderBy("k").limit(6)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in head and "Exchange" not in head


def test_a_head_is_checked_as_far_as_it_goes(spark):
    rows = lambda keys: spark.createDataFrame([(a, b) for a, b in keys], "a long, b long").repartition(3)
    with pytest.raises(ValueError, match="1 rows that repeat"):
        slices.slice_rows(rows([(1, 1), (1, 1), (2, 1)]), ["a", "b"], 0, 1)
    with pytest.raises(ValueError, match="1 rows without"):
        slices.slice_rows(rows([(1, 1), (2, 1), (9, None)]), ["a", "b"], 0, 1)
    late = rows([(1, 1), (2, 1), (3, 1), (3, 1)])
    assert [tuple(r) for r in slices.slice_rows(late, ["a", "b"], 0, 1).collect()] == [(1, 1)]
    with pytest.raises(ValueError, match="repeat"):
        slices.slice_rows(late, ["a", "b"], 0, 2, strict=True)
    assert slices.slice_rows(late.limit(0), ["a", "b"], 0, 3).collect() == []


@pytest.mark.parametrize(("keys", "said"), [([1, 2, 2, 3], "repeats one"), ([1, None], "without one"), ([None, None], "without one")])
def test_batches_refuse_null_and_repeated_keys(spark, keys, said):
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(2)
    for epochs in (1, 3):
        with pytest.raises(Exception, match=said):
            batching.assign_batches(df, "k", epochs, 2).collect()
