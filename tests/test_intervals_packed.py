import random

from pyspark.sql import functions as F

from susurrus.operators.intervals import periods_and_gaps
from susurrus.operators.packed import infer_delimiters, unpack
from susurrus.operators.prefix import running_sum

DDL = "src string, v string, a double, b double, kind int"


def brute(rows):
    out, by = set(), {}
    for v, a, b in rows:
        if a is not None and b is not None and a == a and b == b and abs(a) < 1e9 and abs(b) < 1e9 and round(a * 1000) < round(b * 1000):
            by.setdefault(v, []).append((round(a * 1000), round(b * 1000)))
    for v, xs in by.items():
        xs.sort()
        s, e = xs[0]
        for a, b in xs[1:]:
            if a > e:
                out |= {(v, "period", s, e), (v, "gap", e, a)}
                s, e = a, b
            else:
                e = max(e, b)
        out.add((v, "period", s, e))
    return out


def test_periods_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["x", "y", None]), round(rng.uniform(0, 3000), 3), None) for _ in range(400)]
    rows = [(v, a, round(a + rng.expovariate(1 / 8), 3)) for v, a, _ in rows]
    rows += [("x", None, 1.0), ("x", 5.0, None), ("x", 9.0, 9.0), ("x", 10.0, 4.0), ("y", float("nan"), 1.0), ("z", 0.0, float("inf")), ("z", 1.0, 2.0), ("z", 2.0, 3.0), ("z", 2.0, 3.0)]
    df = spark.createDataFrame([("t", v, a, b, 1) for v, a, b in rows], DDL)
    got = {(r.v, r["kind"], r.from_ms, r.to_ms) for r in periods_and_gaps(df, ["v"], "a", "b", bucket_ms=20_000).collect()}
    assert got == brute(rows)


def test_gap_limit_and_empty(spark):
    df = spark.createDataFrame([("t", "v", 0.0, 1.0, 1), ("t", "v", 2.0, 3.0, 1), ("t", "v", 9.0, 10.0, 1)], DDL)
    gaps = periods_and_gaps(df, ["src", "v"], "a", "b", max_gap_ms=1000).where("kind = 'gap'").collect()
    assert [(g.from_ms, g.to_ms) for g in gaps] == [(1000, 2000)]
    assert periods_and_gaps(df.limit(0), ["v"], "a", "b").count() == 0


def test_running_sum_keeps_order_over_buckets(spark):
    rows = [(k, i // 7, i, None if i % 5 == 0 else i) for k in "ab" for i in range(40)]
    df = spark.createDataFrame(rows, "k string, bucket int, i int, x int")
    for r in running_sum(df, ["k"], "bucket", ["i"], "x", "upto").collect():
        assert r.upto == sum(j for j in range(r.i + 1) if j % 5)


def cells(spark, values, source="n"):
    return spark.createDataFrame([(source, str(i), v, "kept away") for i, v in enumerate(values)], "source string, k string, cell string, val string")


def values(df):
    out = {}
    for r in df.orderBy("k", "pos").collect():
        out.setdefault(r.k, []).append(r.val)
    return out


def test_unpack_numbers(spark):
    x = ["1.5;2.5", " 1.5 | 2.5 / 3.5 ; ", '"1,5", "2,5"', "1.5 2.5", "[1.5, 2.5]", "1.5", '"1,5"', None, "", " ; ", "0:01:02.5\t3.5", "1.5、2.5", "'1,5'|'2,5'", "1.5\n2.5"]
    got = values(unpack(cells(spark, x), "source", "cell", ["k"]))
    assert got == {"0": ["1.5", "2.5"], "1": ["1.5", "2.5", "3.5"], "2": ["1,5", "2,5"], "3": ["1.5", "2.5"], "4": ["1.5", "2.5"], "10": ["0:01:02.5", "3.5"], "11": ["1.5", "2.5"], "12": ["1,5", "2,5"], "13": ["1.5", "2.5"]}


def test_unpack_words_and_quotes(spark):
    x = ["tapping; drumming ;patting", 'a|b | "c, d" |e', "slicing; 'shaving, soap'; filing", 'pouring , "spraying ""mist"""', ";x; y;", "long phrase here", 'open "quote; b', "page one"]
    got = values(unpack(cells(spark, x, "w"), "source", "cell", ["k"]))
    assert got["1"] == ["a", "b", "c, d", "e"] and got["2"] == ["slicing", "shaving, soap", "filing"] and got["3"] == ["pouring", 'spraying "mist"'] and got["4"] == ["x", "y"]
    assert "5" not in got and "7" not in got and got["6"] == ['open "quote', "b"]


def test_delimiters_per_source_and_long_cells(spark):
    df = cells(spark, ["1;2;3"], "a").unionByName(cells(spark, ["red fox", "blue jay", "x|y"], "b"))
    assert infer_delimiters(df, "source", "cell") == {"a": [";"], "b": ["|"]}
    long = cells(spark, [";".join(f'"{i},5"' for i in range(20_000)), "1;2"])
    assert unpack(long, "source", "cell", ["k"]).where("k = '0'").agg(F.max("pos")).first()[0] == 19_999
    assert unpack(long.limit(0), "source", "cell", ["k"]).count() == 0


def test_signs_inside_values_are_no_delimiters(spark):
    x = ["on/off switch; n/a; lamp", "input/output; fader", "n/a; on/off switch", "lamp; fader; n/a", "input/output", "cable; n/a", "left, right; n/a"]
    df = cells(spark, x, "w")
    assert infer_delimiters(df, "source", "cell") == {"w": [";"]}
    got = values(unpack(df, "source", "cell", ["k"]))
    assert got["0"] == ["on/off switch", "n/a", "lamp"] and "4" not in got and got["6"] == ["left, right", "n/a"]
    # one separator, and a sign that stands in a few cells only beside it
    one = cells(spark, ["a|b|c", "d|e", "f|g|h/i"] * 5, "o")
    assert infer_delimiters(one, "source", "cell") == {"o": ["|"]}


def test_candidates_are_scored_alone(spark):
    from susurrus.operators.packed import delimiter_scores

    got = {r.delimiter: r for r in delimiter_scores(cells(spark, ["a;b", "c;d;e", "f/g;h", None, "", ";"]), "source", "cell").collect()}
    assert set(got) == {";", "/"} and got[";"].cells == 3 and abs(got[";"].pieces - 7 / 3) < 1e-9 and got[";"].regular == 1.0
    assert got["/"].cells == 1 and got["/"].pieces == 2 and got["/"].regular == 0 and got["/"].deviation == 0
