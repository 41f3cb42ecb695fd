from tillwork.functions.names import clean_names, trim_names
from tillwork.operators.joins import join_suffix, left_join_many, small_enough


def test_clean_names_removes_every_quote(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["'Cust\"Id'", '"NAME"', " x"])
    assert clean_names(df).columns == ["custid", "name", " x"]


def test_trim_names_strips_only_the_ends(spark):
    df = spark.createDataFrame([(1, 2)], ["'A\"B'", '" C "'])
    assert trim_names(df).columns == ['a"b', " c "]
    assert trim_names(df, quotes='"', lower=False).columns == ["'A\"B'", " C "]


def test_join_suffix_renames_clashes_only(spark):
    left = spark.createDataFrame([(1, "a")], "id int, v string")
    right = spark.createDataFrame([(1, "b", "c")], "ID int, V string, w string")
    right = right.withColumnRenamed("ID", "id")
    joined = join_suffix(left, right, "id", suffix="_r")
    assert joined.columns == ["id", "v", "id_r", "V_r", "w"]
    assert [tuple(row) for row in joined.collect()] == [(1, "a", 1, "b", "c")]


def test_left_join_many_equals_left_join(spark, rows):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e")], "id int, v string")
    many = [(1, n) for n in range(500)] + [(2, 1), (None, 7), (9, 9)]
    right = spark.createDataFrame(many, "id int, n int")
    plain = join_suffix(left, right, "id")
    split = left_join_many(left, right, "id")
    assert split.columns == plain.columns
    assert rows(split) == rows(plain)
    assert split.count() == 500 * 2 + 1 + 1 + 1


def test_small_enough_hints_only_below_the_bound(spark):
    def hinted(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()

    assert hinted(small_enough(spark.range(5), 5))
    assert not hinted(small_enough(spark.range(6), 5))
