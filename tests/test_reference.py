import hashlib
import math
import random
import struct
import wave
from io import BytesIO

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from susurrus.functions import text as X
from susurrus.functions import times as T
from susurrus.operators import audio, bank, embeddings, matching, providers, release, runlog, sampling, scoring, segmentation, timelines
from susurrus.plans import bank as bank_plans
from susurrus.plans import collection
from susurrus.plans import io as io_plans
from susurrus.plans import more, records, reference
from susurrus.sources import readers, writers
from susurrus.streaming import incremental

DATA = "/root/testdata/sf0.001"


def one(spark, *cols, **row):
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {'string' if v is None or isinstance(v, str) else 'double'}" for k, v in row.items()))
    return tuple(df.select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first())


def plain(v):
    if isinstance(v, float):
        return round(v, 5)
    return float(v) if type(v).__name__ == "Decimal" else v


@pytest.mark.parametrize("name", sorted(reference.ORACLES | more.ORACLES | bank_plans.ORACLES | records.ORACLES | io_plans.ORACLES | collection.ORACLES) + ["p3_found", "p3_coverage"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("timeline segment_label_parse train_events train_label manual_gt_example noun_alias_v1 asmr_verb_classes_en documents eval_item part orders customer lineitem events embeddings").split():
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    got = entry.queries()[name](spark, DATA)
    want = con.sql(entry.oracle_sql()[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    at = [want.columns.index(c) for c in cols]
    assert sorted(repr([plain(r[c]) for c in cols]) for r in got.collect()) == sorted(repr([plain(r[i]) for i in at]) for r in want.fetchall())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_text_forms(spark):
    assert one(spark, X.token(F.col("x")), X.noun(F.col("y")), X.slug(F.col("z")), x=" Page Turning ", y="Left  Hand", z="A & b") == ("page_turning", "hands", "a-b")
    assert one(spark, *[X.noun_phrase(F.col(c)) for c in "abcde"], a="red metallic ear pick", b="Hand", c="sealing wax stickers", d="fail", e=None) == ("metal tool", "hands", "wax stickers", "fail", None)
    assert one(spark, *[X.is_blocked(F.col(c)) for c in "abcde"], a="Mixed Beeswax Soup", b="mix", c="mixing clay", d="Intro", e="tapping") == (False, True, False, True, False)
    assert one(spark, *[X.failure_reason(F.col(c)) for c in "abc"], a="timeout http 429", b="ffmpeg not found", c="") == ("rate_limit", "media_processing", "unknown")
    assert one(spark, *[X.confidence(F.col(c)) for c in "abcd"], a="2.5", b="x", c="99", d="3.5") == (2, 1, 10, 4)
    assert one(spark, X.audio_id(F.col("a")), X.audio_id(F.col("b")), a="/d/splitted/vid/1_2/x y.wav", b="c/d.wav") == ("vid__1_2__x_y", "d")


def test_singular_tools_and_ears(spark):
    forms = {"yes": "y", "ties": "ty", "ies": "i", "es": "e", "s": "s", "boxes": "box", "cups": "cup", "glass": "glass", "as": "a", "berries": "berry", "": ""}
    got = spark.createDataFrame([(k,) for k in forms], "w string").select("w", X.singular(F.col("w")).alias("s")).collect()
    assert {r.w: r.s for r in got} == forms
    tools = {"blue cotton swab stick": "cotton swab", "hairbrush set": "brush", "fork brush thing": "brush", "old wooden paint brush x": "wooden brush", "long tweezers": "metal tool", "two cotton tips": "cotton swab", "fork": "fork", "bamboo earpick": "wooden tool"}
    got = spark.createDataFrame([(k,) for k in tools], "w string").select("w", X.noun_phrase(F.col("w")).alias("s")).collect()
    assert {r.w: r.s for r in got} == tools
    ears = [("ear", "Silicone ears test", "silicone ear"), ("Ears", "EAR CLEANING", "silicone ears"), ("ear", "walk", "ear"), ("earbuds", "binaural", "silicone ear"), ("earphone", None, "mic"), ("small crystal ear", None, "glass ear"), ("wooden head", None, "silicone ear"), ("ear-shaped bowl", None, "ear-shaped bowl")]
    got = spark.createDataFrame(ears, "w string, c string, want string").select("want", X.noun_phrase(F.col("w"), F.col("c")).alias("s")).collect()
    assert all(r.want == r.s for r in got), got


def test_finished_annotations_and_leaks(spark):
    rows = [("complete", "a", "b", True), (None, "a", "b", True), ("anything", "a", "b", True), (" Skipped ", "a", "b", False), ("EXCLUDED", "a", "b", False), ("complete", " ", "b", False), ("complete", "a", None, False)]
    got = spark.createDataFrame(rows, "s string, u string, v string, want boolean").select("want", X.is_completed(F.col("s"), F.col("u"), F.col("v")).alias("got")).collect()
    assert all(r.want == r.got for r in got)
    aliases = {"wood": "wood", "sand paper": "paper", "rough sand paper": "stone", "glass": "glass"}
    want = {
        "sponge": None, "wooden surface": None, "some material": ("contains_word_material", None), "Glass": ("exact_alias:glass", "glass"), "ice": ("extra_core:ice", "glass"), "the rough sand papers": ("subphrase_alias:rough sand paper", "stone"),
        "old sand paper": ("subphrase_alias:sand paper", "paper"), "wood glass": ("token_alias:wood", "wood"), "big chalks": ("extra_token:chalk", "ceramic"), "big marbles": None, "woods": ("token_alias:wood", "wood"), "tin": None, "": None, None: None,
    }
    got = spark.createDataFrame([(k,) for k in want], "c string").select("c", X.leaked_material(F.col("c"), aliases).alias("h")).collect()
    assert {r.c: (tuple(r.h) if r.h else None) for r in got} == want


def test_numbering_quantiles_and_windows(spark):
    from susurrus.operators.prefix import numbered

    rng = random.Random(12)
    rows = [(rng.choice(["hot"] * 5 + ["a", "b", None]), i, rng.choice([None, rng.random(), 0.5])) for i in range(900)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, i int, v double").repartition(5)
    by = {}
    for k, i, v in sorted(rows, key=lambda r: r[1]):
        by.setdefault(k, []).append((i, v))
    place = {(k, i): n for k, xs in by.items() for n, (i, _) in enumerate(xs)}
    assert {(r.k, r.i): r.at for r in numbered(df, ["k"], ["i"], "at").collect()} == place
    assert sorted((r.i, r.at) for r in numbered(df, [], ["i"], "at").collect()) == [(i, i) for i in range(900)]
    assert numbered(df.limit(0), ["k"], ["i"], "at").count() == 0
    q = {r.k: r.q for r in segmentation.quantiles(df, ["k"], "v", [0.0, 0.25, 0.5, 1.0]).collect()}
    for k, xs in by.items():
        assert np.allclose(q[k], np.percentile([v for _, v in xs if v is not None], [0, 25, 50, 100]))
    got = {(r.k, r["first"]): (r["mean"], r["std"]) for r in segmentation.sliding(df.fillna(0.0, ["v"]), ["k"], ["i"], "v", 7, 3).collect()}
    want = {}
    for k, xs in by.items():
        v = np.array([x or 0.0 for _, x in xs])
        for a in range(0, len(v) - 6, 3):
            want[k, a] = (v[a : a + 7].mean(), math.sqrt(v[a : a + 7].var() + 1e-8))
    assert set(got) == set(want) and all(np.allclose(got[x], want[x]) for x in want)


def test_times(spark):
    assert one(spark, *[T.seconds_of(F.col(c)) for c in "abcd"], a="2:43:34", b="2:43", c="1:2:3:4", d="a:10") == (9814, 163, None, None)
    got = one(spark, *[x for c in "abc" for x in T.timeline_line(F.col(c))], a="2:43:34 - brush", b="0:05 | tap", c="no time")
    assert got == ("2:43:34", "brush", "0:05", "tap", None, None)
    for lo, hi, off, want in ((10.0, 20.0, 2.0, 12.0), (10.0, 11.0, 2.0, 10.5), (5.0, 5.0, 1.0, 5.025), (0.0, 100.0, 0.0, 0.05)):
        assert math.isclose(one(spark, T.capture_point(F.col("a"), F.col("b"), F.col("c")), a=lo, b=hi, c=off)[0], want)


def test_timeline_from_description_and_ends(spark):
    d = spark.createDataFrame([("v", "0:05 x\nno\n0:05 y\n0:09 z")], "video_id string, text string")
    assert [(r.seconds, r.title) for r in timelines.parse_description(d, "video_id", "text").orderBy("pos").collect()] == [(5, "x"), (9, "z")]
    t = spark.createDataFrame([("v1", 0, "0:10", 10, 42.5), ("v1", 1, "0:05", 7, 42.5), ("v1", 2, "0:30", 30, 42.5), ("v1", 3, None, None, 42.5)], "v string, pos int, time string, seconds int, dur double")
    got = timelines.normalize(t, "v", "pos", "time", "seconds", "dur", strict=False).orderBy("second").collect()
    assert [(r.start, r["end"], r.corrected) for r in got] == [(5.0, 10.0, True), (10.0, 30.0, False), (30.0, 42.5, False)]
    with pytest.raises(Exception, match="neither a time nor seconds"):
        timelines.normalize(t, "v", "pos", "time", "seconds", "dur").collect()
    early = t.where("time is not null").withColumn("dur", F.lit(20.0))
    with pytest.raises(Exception, match="track ends before"):
        timelines.normalize(early, "v", "pos", "time", "seconds", "dur").collect()
    assert timelines.normalize(early, "v", "pos", "time", "seconds", "dur", strict=False).orderBy("second").collect()[-1]["end"] is None


def test_identifiers_and_intervals(spark):
    right = spark.createDataFrame([("r1", "k", "p/x.wav"), ("r2", "k", "p/y.wav")], "rid string, id string, wav string")
    left = spark.createDataFrame([("l1", "k", "p/y.wav"), ("l2", "k", None), ("l3", None, None)], "lid string, id string, wav string")
    keys = matching.identifiers(F.col("id"), path=F.col("wav"))
    got = {r.lid: (r.rid, r["key"]) for r in matching.match_identifiers(left, "lid", keys, right, "rid", keys).collect()}
    assert got == {"l1": ("r2", "p/y.wav"), "l2": (None, None), "l3": (None, None)}
    a = spark.createDataFrame([("v", 10.0, 20.0)], "v string, start double, end double")
    b = spark.createDataFrame([("v", 10.5, 20.5, 1), ("v", 9.6, 20.0, 0), ("v", 10.6, 20.0, 2), ("w", 10.0, 20.0, 3)], "v string, start double, end double, i int")
    assert sorted(r.r_i for r in matching.match_intervals(a, b, ["v"]).collect()) == [0, 1]


def test_presence(spark):
    f = lambda ids: spark.createDataFrame([(i,) for i in ids], "id long")
    got = {r.id: (r.a, r.b, r.c) for r in matching.presence({"a": f([1, 2, 3]), "b": f([2, 3, 4]), "c": f([3, 4, 5])}).collect()}
    assert got["3"] == (1, 1, 1) and got["1"] == (1, 0, 0) and got["5"] == (0, 0, 1)


def test_multi_run_scoring(spark):
    o = lambda *x: [{"label": a, "value": b, "verb_class": c} for a, b, c in x]
    q = [("verb_1", "verb_mc", "A", o(("A", "tapping", "impact"), ("B", "patting", "impact"), ("C", "rubbing", "friction"))), ("subject_1", "subject_material_mc", "B", o(("A", "wood", None), ("B", "skin", None))), ("object_1", "object_material_mc", "A", o(("A", "glass", None), ("B", "wood", None)))]
    qs = spark.createDataFrame(q, "question_id string, task string, gold_label string, options array<struct<label string, value string, verb_class string>>")
    p = [(i, k, v) for i, run in enumerate([("A", "B", "A"), ("B", "B", "A"), ("C", "A", "A")]) for k, v in zip(("verb_1", "subject_1", "object_1"), run, strict=True)]
    got = {r.metric: (r["mean"], r["std"]) for r in scoring.average_runs(scoring.score_runs(qs, spark.createDataFrame(p, "run_id int, question_id string, pred string"))).collect()}
    for k, (m, s) in {"verb_mc": (1 / 3, 0.4714045), "superclass": (2 / 3, 0.4714045), "object_material_mc": (1.0, 0.0), "macro": (2 / 3, 0.2721655), "overall": (2 / 3, 0.2721655)}.items():
        assert math.isclose(got[k][0], m, abs_tol=1e-6) and math.isclose(got[k][1], s, abs_tol=1e-6)


def test_kappa_votes_letters(spark):
    k = spark.createDataFrame([("k", a, b) for a, b in (("a", "a"), ("a", "b"), ("b", "b"), ("b", "b"), (None, None))], "g string, l string, r string")
    r = scoring.cohen_kappa(k, ["g"], "l", "r").first()
    assert math.isclose(r.kappa, 0.6875) and math.isclose(r.expected, 0.36)
    v = [(q, i, kind, c) for q, ref, sil in (("q1", (1, 1, 0), (0, 0, 1)), ("q2", (1, 0, 0), (0, 0, 0)), ("q3", (1, 1, 1), (1, 1, 0))) for kind, cs in (("reference", ref), ("silence", sil)) for i, c in enumerate(cs)]
    got = scoring.vote_subset(spark.createDataFrame(v, "question_id string, run_id int, kind string, correct int"), "kind", "correct").collect()
    assert [x.question_id for x in got] == ["q1"]
    s = spark.createDataFrame([(1, "A", -1.0, 0), (1, "B", -1.0, 1), (2, "A", -1e9, 0)], "k int, letter string, score double, rank int")
    assert {r.k: r.best for r in scoring.best_letter(s, "k", "letter", "score", "rank").collect()} == {1: "A", 2: None}


def test_label_metrics_against_loop(spark):
    rng = random.Random(1)
    rows = [(rng.choice("abc"), rng.choice(["a", "b", "d", None])) for _ in range(200)]
    got = {r.label: r for r in scoring.label_metrics(spark.createDataFrame(rows, "g string, p string"), "g", "p").collect()}
    for c in "abc":
        hit, said, sup = sum(g == p == c for g, p in rows), sum(p == c for _, p in rows), sum(g == c for g, _ in rows)
        pr, rc = hit / said if said else 0, hit / sup
        assert math.isclose(got[c].f1, 2 * pr * rc / (pr + rc) if pr + rc else 0)


def test_distant_subsets_against_brute_force(spark):
    from itertools import combinations

    rng = random.Random(2)
    mats = [m for f in bank.FAMILIES for m in f] + ["stone"]
    fam = {m: f[0] for f in bank.FAMILIES for m in f} | {"stone": "stone"}
    rows = [sorted(rng.sample(mats, rng.randint(1, 6))) for _ in range(40)]
    got = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, m array<string>").select("i", bank.distant_subsets(F.col("m")).alias("s")).collect()
    for r in got:
        ms = rows[r.i]
        ok = [set(c) for n in range(2, len(ms) + 1) for c in combinations(ms, n) if len({fam[x] for x in c}) == n]
        best = [s for s in ok if not any(s < t for t in ok)]
        assert sorted(map(sorted, r.s)) == sorted(map(sorted, best))


def test_options_order_is_md5(spark):
    q = spark.createDataFrame([("t2_om__clip_a", "glass", ["glass"])], "qid string, gold string, grp array<string>")
    pool = ["plastic", "wood", "clay", "foam_lather", "foam_solid", "rubber", "glass", "metal", "textile_fibrous", "paper", "leather", "wax"]
    got = {r.label: r.value for r in bank.options(q, pool, "qid", "gold", "grp").collect()}
    h = lambda s: hashlib.md5(s.encode()).hexdigest()
    far = sorted((m for m in pool if m not in ("plastic", "glass", "metal")), key=lambda m: h(f"t2_om__clip_a:pad:{m}"))[:3]
    assert [got[c] for c in "ABCD"] == sorted(["glass", *far], key=lambda m: h(f"t2_om__clip_a:{m}"))
    assert got == {"A": "rubber", "B": "foam_lather", "C": "glass", "D": "foam_solid"}


def test_round_robin_and_release(spark):
    rows = [(f"tap_{i}", "tapping") for i in range(4)] + [(f"rub_{i}", "rubbing") for i in range(4)] + [("x", None)]
    got = sampling.round_robin(spark.createDataFrame(rows, "wav string, verb string"), "verb", "wav", 4, 7).collect()
    assert sorted(r.verb for r in got) == ["rubbing", "rubbing", "tapping", "tapping"]
    a = spark.createDataFrame([("b",), ("a",), (" b",), ("a\t",), ("b",), (None,), (" ",)], "author string")
    assert {r.author: r.creator_id for r in release.creator_ids(a, "author").collect()} == {"a": "creator_01", "b": "creator_02"}
    s = spark.createDataFrame([("train", "1"), ("test", "1"), ("train", "2")], "split string, id string")
    with pytest.raises(ValueError, match="repeated"):
        release.require_no_leaks(s, "split", "id")
    sizes = [5, 6, 4, 9, 3, 15, 1]
    g = release.greedy_shards(spark.createDataFrame(list(enumerate(sizes)), "pos int, size long"), ["pos"], "size", 10).orderBy("pos").collect()
    assert [r.shard for r in g] == [0, 1, 1, 2, 3, 4, 5]


def test_segmentation(spark):
    merged = lambda xs, least: spark.createDataFrame([(xs,)], "b array<int>").select(segmentation.merge_short(F.col("b"), least).alias("m")).first().m
    assert merged([0, 2, 7, 9, 20], 5) == [0, 7, 20]
    assert merged([0, 5, 11, 20], 10) == [0, 11, 20] and merged([20, 0, 0], 99) == [0, 20] and merged([0, 15, 20], 10) == [0, 15, 20] and merged([], 5) == []
    x = spark.createDataFrame([("v", [1.0, 3.0, 5.0, 7.0, 9.0, 11.0], [0, 3, 6], 100.0, 112.0)], "v string, c array<double>, b array<int>, s double, e double")
    got = segmentation.cut_segments(x, "v", "c", "b", "s", "e", 2.0, 3.0).orderBy("segment").collect()
    assert [(r.start, r["end"], r.kept) for r in got] == [(100.0, 105.0, True), (107.0, 112.0, True)]
    rng = np.random.default_rng(0)
    v = np.concatenate([rng.normal(m, 0.2, 30) for m in (0, 4, 0)])
    assert segmentation.pelt_rbf(v[:, None], 3.0, 5) == [30, 60, 90]
    assert segmentation.pelt_rbf(np.zeros((3, 1)), 3.0, 5) == [3]


def test_change_points_see_a_whole_key(spark):
    rng = np.random.default_rng(5)
    at = np.arange(4_003)
    hot = np.where((at >= 1_000) & (at < 3_000), 4.0, 0.0) + rng.normal(0, 0.2, len(at))
    rows = [("hot", int(i), float(v)) for i, v in zip(at, hot, strict=True)] + [("cold", i, float(i >= 10)) for i in range(20)] + [("cold", 99, None)]
    got = segmentation.change_points(spark.createDataFrame(rows, "k string, i int, v double").orderBy("v"), "k", ["i"], ["v"]).orderBy("k", "segment").collect()
    assert [tuple(r) for r in got] == [("cold", 0, 0, 9), ("cold", 1, 10, 19), ("hot", 0, 0, 999), ("hot", 1, 1_000, 2_999), ("hot", 2, 3_000, 4_002)]


def test_median_of_squared_distances():
    rng = np.random.default_rng(6)
    for n, d in [(2, 1), (61, 1), (62, 1), (61, 2), (62, 3)]:
        for x in (rng.normal(0, 1, (n, d)), rng.integers(0, 4, (n, d)).astype(float)):
            sq = ((x[:, None] - x[None]) ** 2).sum(2)[np.triu_indices(n, 1)]
            assert segmentation.median_square(x) == (np.median(sq[sq > 0]) if (sq > 0).any() else 0)
    x = rng.integers(0, 9, (1_203, 2)).astype(float)
    for y in (x, x[:, :1]):
        sq = ((y[:, None] - y[None]) ** 2).sum(2)[np.triu_indices(len(y), 1)]
        assert segmentation.median_square(y) == np.median(sq[sq > 0])


def test_frechet_and_cosine(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(0, 1, (200, 4)), rng.normal(1, 2, (200, 4))
    f = lambda x: spark.createDataFrame([(list(map(float, v)),) for v in x], "v array<double>")
    assert abs(embeddings.frechet(f(a), f(a), "v")) < 1e-6
    m, c, d = a.mean(0) - b.mean(0), np.cov(a.T), np.cov(b.T)
    ev = np.linalg.eigvals(c @ d)
    assert math.isclose(embeddings.frechet(f(a), f(b), "v"), m @ m + np.trace(c) + np.trace(d) - 2 * np.sqrt(np.abs(ev)).sum(), rel_tol=1e-6)


def test_run_log(spark):
    rows = [("s", "success", None, None), ("s", "failed", None, "HTTP 429 too many requests"), ("s", "failed", None, "ffmpeg decode failed")]
    x = runlog.with_reason(spark.createDataFrame(rows, "stage string, status string, reason string, text string"), "status", "reason", "text")
    assert {r.reason: r.n for r in runlog.summary(x, "stage", "status").collect() if r.reason} == {"rate_limit": 1, "media_processing": 1}
    kept = runlog.kept_details(x.where("status = 'failed'"), "stage", "text", most=1).collect()
    assert len(kept) == 1 and kept[0].dropped == 1


def test_reason_behind_the_kept_detail(spark):
    x = runlog.with_reason(spark.createDataFrame([("s", "failed", None, "x " * 400 + "HTTP 429")], "stage string, status string, reason string, text string"), "status", "reason", "text").first()
    assert x.reason == "rate_limit" and len(x.detail) == 500


def test_provider_is_called_once_per_text(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "t string")
    got = sorted((r.t or "", r.o) for r in providers.apply_distinct(df, "t", F.col("t") == "a", providers.stub("x:"), "o").collect())
    assert got == [("", None), ("a", "x:" + hashlib.md5(b"a").hexdigest()), ("a", "x:" + hashlib.md5(b"a").hexdigest()), ("b", "b")]

    def fails(texts):
        raise OSError

    assert {r.o for r in providers.apply_distinct(df, "t", F.col("t") == "a", fails, "o").collect()} == {"a", "b", None}


def wav(n=160, rate=16000, value=0):
    out = BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(struct.pack("<h", value) * n)
    return out.getvalue()


def test_audio(spark):
    df = spark.createDataFrame([(bytearray(wav(value=8192)),), (bytearray(b"no"),), (None,)], "c binary")
    got = df.select(audio.audio_facts("c").alias("f")).collect()
    assert math.isclose(got[0].f.seconds, 0.01) and math.isclose(got[0].f.rms, 0.25) and got[1].f.seconds is None and got[2].f.rms is None
    louder = df.limit(1).select(audio.amplified("c", F.lit(2.0)).alias("c")).select(audio.audio_facts("c").alias("f")).first().f
    assert math.isclose(louder.rms, 0.5, abs_tol=1e-3)
    assert audio.frame_features(np.zeros((2048, 1)), 16000).shape == (3, 5) and audio.frame_features(np.zeros((10, 1)), 16000).shape == (0, 5)


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"data": [{"wav": "x", "n": 1}, null]}')
    (tmp_path / "b.json").write_text('[{"wav": "y", "n": 2}]')
    got = readers.json_rows(spark, str(tmp_path / "*.json"), "struct<wav:string,n:int>").orderBy("wav").collect()
    assert [(r.wav, r.n, r.pos) for r in got] == [("x", 1, 0), ("y", 2, 0)]
    (tmp_path / "vid").mkdir()
    (tmp_path / "vid" / "timeline.csv").write_text("﻿video_id, time ,start,end\n,0:01,1,2\nw,0:02,,3\n")
    assert [(r.video_id, r.start, r["end"]) for r in readers.timeline_csv(spark, str(tmp_path / "vid")).collect()] == [("vid", 1.0, 2.0)]
    d = spark.createDataFrame([("c1", "a;b"), ("c2", "b")], "verb_class string, verbs string")
    with pytest.raises(Exception, match="two classes"):
        readers.verb_lexicon(d, "verb_class", "verbs").collect()
    p = spark.createDataFrame([(1, "q", " a ", None, 0), (1, "q", None, "b", 1), (1, "r", None, " ", 2)], "run int, q string, pred_label string, pred string, at int")
    assert [(r.question_id, r.pred) for r in readers.predictions(p, "run", "q", "at").collect()] == [("q", "B")]
    rows = spark.createDataFrame([(i, 4) for i in range(7)], "id int, size int")
    shards = lambda **k: [(r["name"], r["rows"], r.written) for r in writers.write_shards(rows, str(tmp_path / "out"), "train", ["id"], "size", 8, **k).orderBy("name").collect()]
    assert shards() == [(f"train-{i:05d}-of-00004.parquet", 2 if i < 3 else 1, True) for i in range(4)]
    (tmp_path / "out" / "train-00001-of-00004.parquet").unlink()
    (tmp_path / "out" / ".train-00002-of-00004.parquet.crc").unlink(missing_ok=True)
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "other"))
    next((tmp_path / "other").glob("part-*")).rename(tmp_path / "out" / "train-00002-of-00004.parquet")  # there, with other rows
    assert [w for *_, w in shards()] == [False, True, True, False] and [w for *_, w in shards(resume=False)] == [True] * 4
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(7))
    (tmp_path / "dis.txt").write_text("intro\ntapping_class — hits\n- one\n- two\nslide — x\n- three\n")
    assert {r.verb_class: r.rules for r in readers.disambiguation(spark, str(tmp_path / "dis.txt")).collect()} == {"tapping_class": ["- one", "- two"], "slide": ["- three"]}


def test_shards_take_as_many_jobs_whatever_their_number(spark, tmp_path):
    """Jobs of a first and of a resumed run don't grow with the shards; files of other splits, of none of the rows, in other
    folders and with odd signs in their names are told apart."""
    track, jobs = spark.sparkContext.statusTracker(), {}
    for n in (4, 120):
        at = tmp_path / str(n)
        rows = spark.createDataFrame([(i, 4, f"x{i}") for i in range(2 * n)], "id int, size int, more string")
        spark.sparkContext.setJobGroup(f"shards-{n}", "")
        run = lambda split, **k: [tuple(r) for r in writers.write_shards(rows, str(at), split, ["id"], "size", 8, **k).orderBy("name").collect()]  # noqa: B023, E731
        assert run("a b[1]") == [(f"a b[1]-{i:05d}-of-{n:05d}.parquet", 2, True) for i in range(n)]
        assert all(r[2] for r in run("train"))
        spark.sparkContext.setJobGroup("other", "")
        name = lambda i: f"train-{i:05d}-of-{n:05d}.parquet"  # noqa: B023, E731
        (at / "below").mkdir()
        (at / name(0)).rename(at / "below" / name(0))
        spark.createDataFrame([], "id int").coalesce(1).write.parquet(str(tmp_path / f"none-{n}"))
        next((tmp_path / f"none-{n}").glob("part-*")).rename(at / name(2))
        (at / f".{name(2)}.crc").unlink(missing_ok=True)
        (at / name(3)).unlink()
        spark.sparkContext.setJobGroup(f"shards-{n}", "")
        assert [k for k, r in enumerate(run("train")) if r[2]] == [0, 2, 3] and not any(r[2] for r in run("a b[1]"))
        spark.sparkContext.setJobGroup("other", "")
        jobs[n] = len(track.getJobIdsForGroup(f"shards-{n}"))
        for split in ("a b[1]", "train"):
            got = [(int(p.name[len(split) + 1 : len(split) + 6]), r["id"], r["size"], r["more"]) for p in at.glob("*.parquet") if p.name.startswith(split) for r in pq.read_table(p).to_pylist()]
            assert sorted(got) == [(i // 2, i, 4, f"x{i}") for i in range(2 * n)]
        assert not list(at.glob(".writing-*"))
    assert 0 < jobs[120] <= jobs[4] + 20


def test_incremental_and_stream(spark, tmp_path):
    rows = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    done = spark.createDataFrame([(1, "ok"), (2, "fail")], "id int, status string")
    assert sorted(r.id for r in incremental.pending(rows, done, "id", F.col("status") == "ok").collect()) == [2, 3]
    src = tmp_path / "in"
    spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "id int, v int, x string").write.parquet(str(src))
    spark.createDataFrame([(1, 2, "c")], "id int, v int, x string").write.mode("append").parquet(str(src))
    t = incremental.Table(spark, str(tmp_path / "table"))
    for _ in range(2):
        s = spark.readStream.schema("id int, v int, x string").option("maxFilesPerTrigger", 1).parquet(str(src))
        incremental.upsert_stream(s, t, ["id"], "v", str(tmp_path / "ck")).awaitTermination()
    got = {r.id: r.x for r in t.read().collect()}
    assert got[2] == "b" and got[1] in ("a", "c") and len(got) == 2


def test_table_rewrites_what_a_batch_touches(spark, tmp_path):
    t = incremental.Table(spark, str(tmp_path / "table"), buckets=8)
    rows = lambda *x: spark.createDataFrame(x, "id int, v int, x string")
    t.merge(rows(*[(i, 1, "a") for i in range(40)]), 0, ["id"], "v")
    first = {p.name for p in (tmp_path / "table" / "v=0").iterdir() if p.name.startswith("__b")}
    t.merge(rows((3, 2, "b"), (3, 1, "z"), (99, 1, "n")), 1, ["id"], "v")
    t.merge(rows((3, 9, "again")), 1, ["id"], "v")  # the batch ran before
    kept = {p.name for p in (tmp_path / "table" / "v=0").iterdir() if p.name.startswith("__b")}
    new = {p.name for p in (tmp_path / "table" / "v=1").iterdir() if p.name.startswith("__b")}
    assert len(first) > len(kept) and kept == first - new and len(new) <= 2 and len(list((tmp_path / "table").glob("manifest-*"))) == 1
    got = {r.id: r.x for r in t.read().collect()}
    assert got == {i: "a" for i in range(40)} | {3: "b", 99: "n"}
    (tmp_path / "table" / "v=7").mkdir()  # left over by a batch that failed: not in a manifest, so not read
    assert t.read().count() == 41


def test_core_without_llm_package(spark, monkeypatch):
    import builtins

    real = builtins.__import__
    import importlib

    def gone(name, *a, **k):
        if name.startswith("susurrus.llm"):
            raise ModuleNotFoundError(name, name="susurrus.llm")
        return importlib_real(name, *a, **k)

    importlib_real = importlib.import_module
    monkeypatch.setattr(importlib, "import_module", gone)
    assert "mc_score_runs" in entry.queries() and not any(k.startswith("p1_") for k in entry.queries())
    assert real is builtins.__import__


def test_verb_padding(spark):
    pool = {"tapping": "strike", "patting": "strike", "drumming": "strike", "rubbing": "slide", "pouring": "liquid", "odd": None}
    q = spark.createDataFrame([("q1", "tapping", ["tapping"]), ("q2", "tapping", ["tapping", "drumming"]), ("q3", "odd", ["odd"]), ("q4", "absent", ["absent"])], "qid string, gold string, grp array<string>")
    show = lambda distant: {k: {(r.value, r.source) for r in bank.verb_options(q, pool, "qid", "gold", "grp", distant).collect() if r.qid == k} for k in ("q1", "q2", "q3", "q4")}
    near = show(False)
    assert near["q1"] == {("tapping", "target"), ("drumming", "near_pool"), ("patting", "near_pool"), ("odd", "near_pool")}
    # two places are free, one of the two nearest verbs is in the group already
    assert near["q2"] == {("tapping", "target"), ("drumming", "same_group"), ("patting", "near_pool")}
    far = show(True)
    h = lambda v: hashlib.md5(f"q1:vpad:{v}".encode()).hexdigest()
    assert far["q1"] == {("tapping", "target")} | {(v, "distant_pool") for v in ["odd", "pouring", "rubbing"]} and len(far["q4"]) == 4
    order = [r.value for r in bank.verb_options(q.where("qid = 'q1'"), pool, "qid", "gold", "grp", True).orderBy("label").collect()]
    assert order == sorted(order, key=lambda v: hashlib.md5(f"q1:{v}".encode()).hexdigest()) and h("odd")


def test_material_group_ids(spark):
    c = spark.createDataFrame([("a", "k", "wood"), ("b", "k", "glass"), ("c", "k", "textile_fibrous"), ("d", "k", "wax"), ("e", "j", "wood"), ("f", "j", "glass"), ("g", "i", "wood"), ("h", "i", "wax")], "item string, key string, m string")
    g = bank.material_groups(c, "om", ["key"], "m", "item")
    assert sorted((r.group_id, tuple(r.subset)) for r in g.collect()) == [("om__j", ("glass", "wood")), ("om__k__dglass-textile-fibrous-wax", ("glass", "textile_fibrous", "wax")), ("om__k__dglass-textile-fibrous-wood", ("glass", "textile_fibrous", "wood"))]
    one = bank.tier_one(c, g, ["key"], "subset", "m", "item").orderBy("question_id").collect()
    assert [(r.question_id, r["item"], r.gold) for r in one][:2] == [("om__j__inst0", "e", "wood"), ("om__j__inst1", "f", "glass")]
    two = bank.tier_two(c, spark.createDataFrame(one), "t2_om", "m", "item").collect()
    assert {r.question_id for r in two} == {"t2_om__g", "t2_om__h"}


def test_scans_refuse_what_is_wrong(spark, tmp_path):
    for models, why in (([{"id": "a b", "audio_dir": "x"}], "invalid"), ([{"id": "a", "audio_dir": "x"}] * 2, "repeated"), ([{"id": "a"}], "without audio_dir")):
        (tmp_path / "m.json").write_text(__import__("json").dumps(models))
        with pytest.raises(Exception, match=why):
            readers.model_registry(spark, str(tmp_path / "m.json")).collect()
    (tmp_path / "l.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    assert [(r.a, r.line_no) for r in readers.numbered_json_lines(spark, str(tmp_path / "l.jsonl"), "a int").collect()] == [(1, 1), (2, 3)]
    for bad in ("[1]", "no"):
        (tmp_path / "b.jsonl").write_text('{"a": 1}\n' + bad)
        with pytest.raises(Exception, match=r"b\.jsonl:2"):
            readers.numbered_json_lines(spark, str(tmp_path / "b.jsonl"), "a int").collect()
    assert readers.ledger(spark, str(tmp_path / "none")).columns == readers.LEDGER and readers.ledger(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "u.txt").write_text("# all\n\n https://a \nhttps://b")
    assert [r.url for r in readers.url_list(spark, str(tmp_path / "u.txt")).collect()] == ["https://a", "https://b"]
    assert readers.marked_prompt("# note\n### SYSTEM\nBe brief.\n#x\n### USER\nSay {X}.\n") == ("Be brief.", "Say {X}.")
    with pytest.raises(ValueError, match="USER"):
        readers.marked_prompt("x")
    (tmp_path / "list.json").write_text('{"nothing": []}')
    with pytest.raises(Exception, match="no list of rows"):
        readers.json_rows(spark, str(tmp_path / "list.json"), "struct<a:int>", required=True).collect()
    a = spark.createDataFrame([("x", "1", 0), ("X ", "2", 1), ("y", " ", 2)], "alias string, grp string, at int")
    assert [tuple(r) for r in readers.last_alias(a, "alias", "grp", "at").collect()] == [("x", "2")]


def test_subsets_and_manifests(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    bank_ = ids("a", "b", "c", "c")
    assert sorted(r.id for r in scoring.restrict(bank_, ids("c", "a", "", None), "id").collect()) == ["a", "c", "c"]
    with pytest.raises(ValueError, match="x"):
        scoring.restrict(bank_, ids("a", "x"), "id")
    assert [r.id for r in matching.aligned({"r": ids("a", "b"), "c": ids("b", "a"), "g": ids("a", "b")}).orderBy("id").collect()] == ["a", "b"]
    with pytest.raises(ValueError, match="ids differ: r=2, c=1, g=2, common=1"):
        matching.aligned({"r": ids("a", "b"), "c": ids("a"), "g": ids("a", "b")})
    assert [r.id for r in matching.aligned({"r": ids("a", "b"), "c": ids("a"), "g": ids("a", "b")}, strict=False).collect()] == ["a"]
    with pytest.raises(ValueError, match="no common"):
        matching.aligned({"r": ids("a"), "c": ids("b")}, strict=False)


def test_letter_scores(spark):
    schema = "k int, tokens array<struct<token:string,logprob:double,top_logprobs:array<struct<token:string,logprob:double>>>>"
    rows = [(1, [(" ", -9.0, None), ("b", -0.5, [(" B", -0.2), ("a", -3.0), ("x", -0.1), ("A ", -2.0), ("C", None)])]), (2, None), (3, [("\n", 0.0, None)]), (4, [("D", -1.0, None), ("A", 0.0, None)])]
    got = {(r.k, r.letter): r.score for r in scoring.letter_scores(spark.createDataFrame(rows, schema), "k", "tokens", list("ABCD")).collect()}
    assert [got[1, c] for c in "ABCD"] == [-2.0, -0.2, scoring.MISSING, scoring.MISSING]
    assert {got[k, c] for k in (2, 3) for c in "ABCD"} == {scoring.MISSING} and [got[4, c] for c in "AD"] == [scoring.MISSING, -1.0]


def test_task_accuracy_counts_two_nulls_as_equal(spark):
    q = spark.createDataFrame([("1", "verb_mc", "a"), ("2", None, None), ("3", "verb_mc", "B")], "question_id string, task string, gold_label string")
    p = spark.createDataFrame([(1, "1", "A "), (2, "1", "b"), (1, "2", None), (2, "2", "A"), (1, "3", "B")], "run_id int, question_id string, pred string")
    got = {r.task: (r.n, r.accuracy) for r in scoring.task_accuracy(q, p, spark.createDataFrame([("1",), ("2",)], "question_id string")).collect()}
    assert got == {"verb_mc": (2, 0.5), "unknown": (2, 0.5)}


def test_record_functions(spark):
    from susurrus.functions import records as R

    assert one(spark, *[R.file_number(F.col(c)) for c in "abcd"], a=12.5, b=3.0, c=0.0000001, d=465783.355) == ("12p5", "3", "0", "465783p355")
    assert one(spark, *[R.section(F.col(a), F.col(b)) for a, b in ("ab", "cd", "ba")], a=1.0, b=1.01, c=59.5, d=3725.25) == ("*1-1.05", "*59.5-1:02:5.25", None)
    assert one(spark, *[R.video_of_url(F.col(c)) for c in "abc"], a="https://x/watch?a=1&v=Ab_1&t=2", b="https://x/v=1", c=None) == ("Ab_1", None, None)
    assert one(spark, R.video_of_ledger(F.col("a"), F.col("b")), R.video_of_ledger(F.col("a"), F.col("c")), a="", b="d\\audio\\vid\\vid.wav", c="x.wav") == ("vid", "")
    assert one(spark, *[R.svo_field(F.col(c), True) for c in "abcde"], a=" NULL ", b="Fail", c="Left_Hand", d=" ", e=None) == (None, "fail", "hands", None, None)
    assert one(spark, R.model_slug(F.col("a")), R.model_slug(F.col("b")), a="Org/Some-Model.V2", b="Org/-") == ("somemodelv2", "model")
    assert one(spark, R.relative_path(F.col("a"), "audio/train", "/data/t"), R.relative_path(F.col("b"), "audio/train", "/data/t"), R.relative_path(F.col("c"), "p"), R.base_path(F.col("a"), "q"), a="/data/t/v/1.wav", b="/x/splitted/v/2.wav", c="/x/3.wav") == ("audio/train/v/1.wav", "audio/train/v/2.wav", "p/3.wav", "q/1.wav")
    assert one(spark, R.filled(F.col("a"), {"X": F.col("b"), "Y": F.col("c")}), a="{X}-{Y}-{Z}", b="1", c=None) == ("1--{Z}",)
    assert one(spark, R.title_has(F.col("a"), R.keywords(" Preview, intro ,,preview")), R.title_has(F.col("b"), ["x"]), a="My PREVIEW", b=None) == (True, False) and R.keywords("A, a") == ["a"]
    assert one(spark, R.json_object(F.col("a"), "x int"), R.json_object(F.col("b"), "x int"), R.json_object(F.col("c"), "x int"), a='```json\n{"x": 1}\n```', b='[{"x": 1}]', c='{"x": ') == ((1,), None, None)
    with pytest.raises(Exception, match="neither audio id nor wav"):
        one(spark, R.manifest_id(F.col("a"), F.col("b")), a=" ", b=None)
    with pytest.raises(Exception, match="no identifier"):
        one(spark, R.preferred_id(matching.identifiers(F.col("a"))), a=" ")
    assert one(spark, R.pair_key(F.col("a"), F.col("b")) == R.pair_key(F.col("c"), F.col("d")), a="A_b", b=None, c="a  b", d=" ") == (True,)
    p = one(spark, R.hashed_point(F.col("s"), F.col("a"), F.col("b")), a=2.0, b=4.0, s="k")[0]
    assert 2.0 <= p <= 4.0


def test_run_payload(spark):
    rows = [("Success", "1", None, None), ("failed", "2", "", "HTTP 429"), ("error", "3", "mine", "x"), ("failed", "4", None, "?"), ("skipped", "5", "late", None)]
    got = runlog.payload(spark.createDataFrame(rows, "status string, id string, reason string, text string"), "s", "status", "id", "reason", "text", most=2)
    assert (got["total"], got["successful"], got["failed"], got["skipped"], got["dropped_failure_details"]) == (5, 1, 3, 1, 1)
    assert got["failure_reasons"] == {"late": 1, "mine": 1, "rate_limit": 1, "unknown": 1} and [f["reason"] for f in got["failures"]] == ["rate_limit", "mine"]


def test_greedy_shards_against_a_loop(spark):
    rng = random.Random(5)
    for target, batch in ((10, "7"), (50, "10000"), (0, "3")):
        sizes = [rng.choice([None, 0, 1, 4, 9, 30]) for _ in range(60)]
        shard, filled, empty, want = 0, 0, True, []
        for s in (x or 0 for x in sizes):
            if not empty and filled + s > target:
                shard, filled = shard + 1, 0
            filled, empty = filled + s, False
            want.append(shard)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        df = spark.createDataFrame(list(enumerate(sizes)), "pos int, size long")
        assert [r.shard for r in release.greedy_shards(df, ["pos"], "size", target).orderBy("pos").collect()] == want
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_representatives_and_unique_wavs(spark):
    e = spark.createDataFrame([(1, ["", "a", "b"]), (2, ["x", "b"]), (3, []), (4, None), (5, [" ", "y", "z"])], "k int, p array<string>")
    f = spark.createDataFrame([("b",), ("a",), ("b",)], "path string")
    assert {r.k: (r.path, r.there) for r in matching.representative(e, "k", "p", f).collect()} == {1: ("a", True), 2: ("b", True), 3: (None, False), 4: (None, False), 5: ("y", False)}
    w = spark.createDataFrame([("f", "f.wav"), ("f", "o.wav"), ("g", "o.wav"), ("g", "o.txt"), ("h", "1.wav"), ("h", "2.wav"), ("i", "x.txt")], "folder string, name string")
    assert {r.folder: r["name"] for r in matching.only_wav(w).collect()} == {"f": "f.wav", "g": "o.wav"}


def test_more_record_functions(spark):
    from susurrus.functions import records as R

    assert one(spark, *[R.window_of_key(F.col(c)) for c in "abcd"], a="1.5_2", b="2_1", c="x_2", d="5") == ((1.5, 2.0), None, None, None)
    assert one(spark, R.listed_url(F.col("a"), F.col("b")), R.listed_url(F.col("a"), F.col("c")), R.listed_url(F.col("d"), F.col("e")), R.listed_url(F.col("d"), F.col("d")), a="id", b="https://x", c=None, d=None, e=" z ") == ("https://x", "https://www.youtube.com/watch?v=id", "https://www.youtube.com/watch?v=z", None)
    assert one(spark, R.first_named(F.col("a"), F.col("b"), F.col("c")), a=None, b=" ", c="x") == ("x",)
    assert one(spark, R.encoded_sound(F.col("a"), F.col("b").cast("binary")), a="d/x.WAV", b="hi")[0] == ("aGk=", "wav")
    with pytest.raises(Exception, match="unsupported sound"):
        one(spark, R.encoded_sound(F.col("a"), F.col("b").cast("binary"))["format"], a="d/x.aiff", b="hi")
    assert one(spark, *T.hms_columns(F.col("a"), F.col("b"), F.col("c")), a=61.5, b=3600.0, c=100.0) == ("0:01:01.500", "1:00:00.000", "0:58:58.500", -38.5, "-0:00:38.500", 3500.0, "0:58:20.000")


def test_documents_and_maps(spark, tmp_path):
    df = spark.createDataFrame([("v", 2, "p"), ("v", 1, "q"), (None, 5, "r")], "v string, i int, secret string")
    rows = {(r.v, r.i): (r.segment_index, r.segment_count) for r in writers.segment_rows(df, "v", ["i"], ["secret"]).collect()}
    assert rows == {("v", 1): (0, 2), ("v", 2): (1, 2), (None, 5): (0, 1)} and "secret" not in writers.segment_rows(df, "v", ["i"], ["secret"]).columns
    writers.write_sorted(df.select("v", "i"), str(tmp_path / "o.json"), "i", judge="m")
    got = __import__("json").loads((tmp_path / "o.json").read_text())
    assert got["judge"] == "m" and [r["i"] for r in got["results"]] == [1, 2, 5]
    writers.write_sorted(df.limit(0), str(tmp_path / "o.json"), "i")
    assert __import__("json").loads((tmp_path / "o.json").read_text()) == {"results": []}
    assert writers.release_manifest({"train": df, "test": df.limit(1)}, str(tmp_path / "m.json")) == {"train": 3, "test": 1}
    writers.write_metadata(spark.createDataFrame([("d/x.wav", 1)], "audio string, k int"), str(tmp_path / "meta"))
    assert [r.audio for r in spark.read.json(str(tmp_path / "meta")).collect()] == ["x.wav"]
