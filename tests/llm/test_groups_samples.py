import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from susurrus.llm import canonical, consensus, leaks, mixing, sampling, splits
from susurrus.llm.components import components


def brute_components(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by = collections.defaultdict(list)
    for n, h in edges:
        if n is not None and h is not None:
            by[h].append(n)
    for ns in by.values():
        for n in ns[1:]:
            a, b = find(ns[0]), find(n)
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("kind", ["random", "chain", "star", "none"])
def test_components(spark, kind):
    rng = random.Random(4)
    nodes = [f"n{i:03d}" for i in range(120)]
    edges = {
        "random": [(rng.choice(nodes), f"h{rng.randint(0, 90)}") for _ in range(130)],
        "chain": [(nodes[i], f"h{i}") for i in range(120)] + [(nodes[i + 1], f"h{i}") for i in range(119)],
        "star": [(n, "h") for n in nodes] + [(nodes[0], None), (None, "h")],
        "none": [(None, "h")],
    }[kind]
    n = spark.createDataFrame([(x,) for x in [*nodes, None, nodes[0]]], "id string")
    e = spark.createDataFrame(edges, "id string, hub string")
    got = {r.id: r.component for r in components(n, e, "id", "hub").collect()}
    assert got == brute_components(nodes, edges)


def test_author_keys(spark):
    raw = ["Ｈｏｌｌｏｗ　Ｂｅｌｌ", "hollow-bell", " - ", "", None, "Unknown", "N/A", "Ｎ／Ａ", "Élan 3", "--"]
    got = [r.k for r in spark.createDataFrame([(i, x) for i, x in enumerate(raw)], "i int, a string").orderBy("i").select(splits.author_key("a").alias("k")).collect()]
    assert got == ["hollowbell", "hollowbell", None, None, None, None, None, None, "élan3", None]


def test_video_groups(spark):
    ev = spark.createDataFrame(
        [("b", "X", [("w1",)]), ("a", None, [("w2",), (None,)]), ("c", "unknown", None), ("d", "unknown", []), (None, "X", None), ("e", "Y!", None), ("f", "y", None)],
        "id string, author string, segments array<struct<audio_path string>>",
    ).withColumn("label", F.lit("clash"))
    lb = spark.createDataFrame([("w2", "x"), ("w2", "x"), (None, "Y"), ("w9", "Y")], "wav string, author string").withColumn("id", F.lit("clash"))
    got = {r.id: r.component for r in splits.video_groups(ev, lb).collect()}
    assert got == {"a": "a", "b": "a", "c": "c", "d": "d", "e": "e", "f": "e"}


def test_grouped_split(spark):
    rng = random.Random(5)
    rows = [("big", rng.choice("xyz")) for _ in range(1500)] + [(f"g{rng.randint(0, 2500)}", rng.choice("xxxyz")) for _ in range(8500)] + [(None, "x"), ("g1", None)]
    df = spark.createDataFrame(rows, "grp string, lab string")
    got = {r.grp: r.split for r in splits.grouped_split(df, "grp", "lab", {"train": 0.8, "validation": 0.1, "test": 0.1, "off": 0.0}).collect()}
    assert set(got) == {g for g, _ in rows if g}
    share = collections.Counter(got[g] for g, _ in rows if g)
    assert abs(share["train"] / 10_001 - 0.8) < 0.02 and abs(share["test"] / 10_001 - 0.1) < 0.02
    for lab in "xyz":
        s = collections.Counter(got[g] for g, x in rows if g and x == lab)
        assert abs(s["train"] / sum(s.values()) - 0.8) < 0.04
    assert splits.grouped_split(df.limit(0), "grp", "lab", {"train": 1.0}).count() == 0
    with pytest.raises(ValueError):
        splits.grouped_split(df, "grp", "lab", {"train": 0.0})


def test_split_keeps_rare_labels_apart(spark):
    rows = [(f"{lab}-{i}", f"v{lab:03d}") for lab in range(300) for i in range(30 if lab < 256 else 20)]
    got = {r.grp: r.split for r in splits.grouped_split(spark.createDataFrame(rows, "grp string, lab string"), "grp", "lab", {"train": 0.8, "test": 0.2}, large_share=1.0).collect()}
    test = collections.Counter(lab for g, lab in rows if got[g] == "test")
    assert [test[f"v{lab:03d}"] for lab in range(256, 300)] == [4] * 44


def test_large_groups_meet_the_shares():
    """49 components of very uneven size, as in the test tables: every share near its target, by label too."""
    rng = np.random.default_rng(3)
    targets = {"train": 0.8, "validation": 0.1, "test": 0.1}
    units = [(f"g{k}", {f"v{j}": int(n) for j, n in enumerate(rng.multinomial(int(700 / (k + 1)) + 5, rng.dirichlet(np.ones(12) * 0.4))) if n}) for k in range(49)]
    placed = splits.iterative_stratification(units, targets)
    whole, by = collections.Counter(), collections.Counter()
    for key, v in units:
        for k, n in v.items():
            whole[placed[key]] += n
            by[k, placed[key]] += n
    total = sum(whole.values())
    assert set(placed) == {k for k, _ in units} and all(abs(whole[s] / total - t) < 0.005 for s, t in targets.items())
    off = [abs(by[f"v{j}", s] / sum(by[f"v{j}", x] for x in targets) - t) for j in range(12) for s, t in targets.items()]
    assert np.mean(off) < 0.03


def test_balance_counts_moves_and_swaps():
    rng = np.random.default_rng(4)
    vectors = [{int(k): float(rng.integers(1, 9)) for k in rng.choice(5, 3, replace=False)} for _ in range(12)]
    b = splits.Balance(vectors, [0.5, 0.3, 0.2], 4.0)
    for u in range(12):
        b.put(u, int(rng.integers(0, 3)))
    cost = lambda: float((b.weight[:, None] * b.off**2).sum())
    for u in range(12):
        was, home, g = cost(), int(b.split[u]), b.gains(u)
        for s in range(3):
            b.put(u, s)
            assert abs(cost() - was - g[s]) < 1e-9
        b.put(u, home)
    before = cost()
    b.refine()
    assert cost() <= before


def test_large_and_small_groups_by_one_method(spark):
    """The result is balanced whatever counts as large, and a group of any size stays whole."""
    rng = random.Random(11)
    rows = [(f"g{int(rng.paretovariate(0.7)) % 900}", rng.choice("xxxxyyz")) for _ in range(6000)]
    df = spark.createDataFrame(rows, "grp string, lab string")
    for large, parts in ((1 / 2000, 64), (1 / 20, 4), (1.0, 8)):
        got = {r.grp: r.split for r in splits.grouped_split(df, "grp", "lab", {"train": 0.8, "test": 0.2}, large, parts).collect()}
        n = collections.Counter(got[g] for g, _ in rows)
        assert set(got) == {g for g, _ in rows} and abs(n["train"] / 6000 - 0.8) < 0.03


TARGETS = "scope string, category string, target_share double, min_rows int, sample_rows long"


def test_sample(spark):
    t = spark.createDataFrame([("s", "a", 0.5, 2, 100), ("s", "b", 0.3, 2, 100), ("s", "c", 0.2, 2, 100), ("s", "none", 0.0, 3, 100)], TARGETS)
    u = [("s", "a", f"a{i}") for i in range(500)] + [("s", "b", f"b{i}") for i in range(300)] + [("s", "c", f"c{i}") for i in range(5)] + [("s", None, "n"), ("s", "a", None), ("s", "zz", "z"), ("s", "a", "a1")]
    units = spark.createDataFrame(u, "scope string, category string, unit string").withColumn("drawn", F.lit("clash"))
    decided = sampling.draw(units, t, block_rows=60)
    got = decided.where("drawn")
    n = collections.Counter(r.category for r in got.collect())
    assert sum(n.values()) == 100 and n["c"] == 5 and abs(n["a"] - 95 * 5 / 8) <= 1 and "zz" not in n
    assert got.distinct().count() == 100 and decided.count() == 805
    rep = {r.category: r.met for r in sampling.report(t, decided).collect()}
    assert rep == {"a": True, "b": True, "c": False, "none": False}
    assert sampling.draw(units.limit(0), t).count() == 0
    assert sampling.draw(units, t.limit(0)).count() == 0


def test_report_comes_from_the_draw(spark):
    t = spark.createDataFrame([("s", "a", 0.5, 2, 100), ("s", "b", 0.5, 2, 100), ("s", "floor", 0.0, 40, 100), ("s", "few", 0.0, 9, 100)], TARGETS)
    u = [("s", c, f"{c}{i}") for c, n in (("a", 500), ("b", 500), ("floor", 60), ("few", 4)) for i in range(n)]
    decided = sampling.draw(spark.createDataFrame(u, "scope string, category string, unit string"), t)
    told = lambda x: {r.category: (r.met, r.reached) for r in sampling.report(t, x).collect()}
    assert told(decided) == {"a": (True, False), "b": (True, False), "floor": (True, True), "few": (False, False)}
    # an empty draw meets nothing; one that loses units of a category misses that one; one that takes too few is seen
    assert set(told(decided.limit(0)).values()) == {(False, False)}
    assert told(decided.where("category <> 'floor' or drawn and unit < 'floor3'"))["floor"] == (False, False)
    assert told(decided.withColumn("drawn", F.col("drawn") & (F.col("category") != "floor")))["floor"] == (True, False)


def test_calibration_is_optimal():
    """Against a fine search over the multiplier, with random shares, floors and caps."""
    rng = np.random.default_rng(1)
    for _ in range(200):
        k = int(rng.integers(1, 8))
        share = rng.dirichlet(np.ones(k)) * (rng.random(k) > 0.1)
        have = rng.integers(0, 200, k).astype(float)
        floor = rng.integers(0, 30, k).astype(float)
        total = float(rng.integers(1, 400))
        x = sampling.calibrated(share, floor, have, total)
        low = np.minimum(floor, have)
        assert (x >= low - 1e-9).all() and (x <= have + 1e-9).all()
        live = (share > 0) & (have > 0)
        most = np.where(live, have, low).sum()
        want = low.sum() if not live.any() else min(max(total, low.sum()), most)
        assert abs(x.sum() - want) < 1e-6 * max(1, want)
        free = live & (x > low + 1e-9) & (x < have - 1e-9)
        if free.sum() > 1:  # what is within its bounds keeps the proportions of the shares
            r = x[free] / share[free]
            assert np.allclose(r, r[0])


def test_pivotal_keeps_sums_and_probabilities():
    rng = np.random.default_rng(0)
    p = rng.uniform(0, 1, 40)
    p *= 12 / p.sum()
    draws = np.array([sampling.pivotal(np.minimum(p, 1), rng.random(40)) for _ in range(3000)])
    assert np.allclose(draws.sum(1), np.minimum(p, 1).sum()) and np.abs(draws.mean(0) - np.minimum(p, 1)).max() < 0.05


REFS = [("fingers", "finger tips"), ("fingers", "fingertips"), ("lid", "tin lid"), ("bowl", "wooden salad bowl"), ("palms", "palms"), ("foam", "shaving foam"), ("floam", "floam"), ("x", None), (None, "y")]


def test_canonical_forms(spark):
    want = {
        "Finger_Tips": "fingers", "the fingertips!": "fingers", "dark green finger  tips, second take": "fingers", "lid, tin": "lid", "tin ld": "lid", "Tin Lid (left side)": "lid", "woooden saald bowl - close up": "bowl",
        "plms": "palms", "shaving foam": "foam", "shavng foam": "foam", "accordion": "unmatched", "bowling lane": "unmatched", " ": "unmatched", "": "unmatched", "???": "unmatched", "ｆｉｎｇｅｒ ｔｉｐｓ": "fingers", "word " * 5000: "unmatched", "t i n l i d": "lid", "held by f i n g e r t i p s": "fingers", "w o o d e n s a l a d b o w l": "bowl",
    }
    v = spark.createDataFrame([(x, "clash") for x in [*want, None, "plms"]], "value string, grp string")
    refs = spark.createDataFrame(REFS, "group_id string, alias string")
    got = {r.value: r.group for r in canonical.match(v, "value", refs, "alias", "group_id").collect()}
    assert got == want
    assert canonical.match(v.limit(0), "value", refs, "alias", "group_id").count() == 0
    assert {r.group for r in canonical.match(v, "value", refs.limit(0), "alias", "group_id").collect()} == {"unmatched"}


def test_canonical_finds_all_within_the_edits(spark):
    """Every string within the allowed edits is found, against brute force."""

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            prev, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
        return row[-1]

    rng = random.Random(6)
    refs = ["palms", "hourglass", "tweezers", "typewriter", "manualtypingmachine", "sandpaper"]
    vals = set()
    for r in refs:
        for _ in range(60):
            s = list(r)
            for _ in range(rng.randint(0, 5)):
                i = rng.randrange(len(s) or 1)
                k = rng.randint(0, 2)
                s[i : i + (k > 0)] = [] if k == 1 else [rng.choice("abcdefgh")]
            vals.add("".join(s))
    k = lambda r: 1 if len(r) <= 5 else 2 if len(r) <= 9 else 3
    got = {x.value: (x.group, x.edits) for x in canonical.match(spark.createDataFrame([(v,) for v in vals if v], "value string"), "value", spark.createDataFrame([(r, r) for r in refs], "group_id string, alias string"), "alias", "group_id").collect()}
    for v in vals - {""}:
        near = [(distance(v, r) / len(r), r, distance(v, r)) for r in refs if distance(v, r) <= k(r)]
        assert got[v] == ((min(near)[1], min(near)[2]) if near else ("unmatched", None))


def test_attach_beyond_the_broadcast_bound(spark, monkeypatch):
    rows = spark.createDataFrame([("a",)] * 50 + [("b",), ("c",)], "typed string").withColumn("n", F.lit(1))
    counted = rows.groupBy(F.col("typed").alias("value")).agg(F.count("*").alias("n"))
    found = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C")], "value string, group string")
    monkeypatch.setattr(canonical, "BROADCAST_ROWS", 1)
    assert collections.Counter(r.group for r in canonical.attach(rows, "typed", counted, found).collect()) == {"A": 50, "B": 1, "C": 1}


GT = "gt_row_id long, item_id string, wav string, split string, gt struct<subject string, verb string, object string>, annotation struct<annotator_id string, status string, notes string>, submitted_at timestamp"


def gt(rows):
    import datetime

    at = lambda k: datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=k)
    return [(i, item, None, None, ("s", v, o), (a, s, None), at(t)) for i, (item, a, v, o, s, t) in enumerate(rows)]


def test_votes(spark):
    rows = [("i", "a", "Page_Turning ", None, "complete", 1), ("i", "a", "tapping", "x", "complete", 0), ("i", "b", None, "x", "complete", 0), ("i", "c", "tapping", " Red_Cup ", "Pending", 0), ("i", "d", "tapping", "red  cup", None, 0), (None, "a", "t", None, "complete", 0), ("i", None, "t", None, "complete", 0)]
    got = {r.annotator: (r.verb, r.object) for r in consensus.votes(spark.createDataFrame(gt(rows), GT)).collect()}
    assert got == {"a": ("page turning", ""), "d": ("tapping", "red cup"), "": ("t", "")}
    assert consensus.fit(consensus.votes(spark.createDataFrame([], GT)))[0].count() == 0


def test_consensus_recovers_truth(spark):
    rng = random.Random(7)
    skill = {"good1": 0.95, "good2": 0.92, "fair": 0.75, "bad1": 0.4, "bad2": 0.4, "same": None}
    labels, truth, rows = list("abcdef"), {}, []
    for i in range(300):
        truth[f"i{i}"] = rng.choice(labels)
        other = rng.choice([x for x in labels if x != truth[f"i{i}"]])
        for a in rng.sample(sorted(skill), 4):
            v = "a" if skill[a] is None else truth[f"i{i}"] if rng.random() < skill[a] else other
            rows.append((f"i{i}", a, v, v, "complete", 0))
    v = consensus.votes(spark.createDataFrame(gt(rows), GT))
    found, people = consensus.fit(v)
    got = {r.item: r.verb for r in found.collect()}
    majority = {}
    for i in truth:
        c = collections.Counter(x[2] for x in rows if x[0] == i)
        majority[i] = min(c, key=lambda k: (-c[k], k))
    right = lambda d: sum(d[i] == t for i, t in truth.items())
    assert set(got) == set(truth) and right(got) > right(majority) and right(got) > 265
    rel = {r.annotator: r.reliability for r in people.collect()}
    assert rel["good1"] > rel["fair"] > rel["bad1"]
    assert all(r.converged for r in people.collect())
    alpha = {r.field: r.alpha for r in consensus.agreement(v).collect()}
    assert 0 < alpha["verb"] < 1
    with pytest.warns(UserWarning, match="still moved"):
        assert not any(r.converged for r in consensus.fit(v, max_rounds=1)[1].collect())


@pytest.mark.parametrize("bound", [200_000, 40, 0])
def test_leaks_against_brute_force(spark, monkeypatch, bound):
    monkeypatch.setattr(leaks, "BROADCAST_WINDOWS", bound)
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(25)]
    items = [(k, " ".join(rng.choice(vocab) for _ in range(20))) for k in range(6)] + [(90, "too short"), (91, None), (92, "")]
    docs = []
    for k in range(120):
        words = [rng.choice(vocab) for _ in range(rng.randint(0, 30))]
        if k % 3 == 0:
            i = rng.choice(items[:6])[1].split()
            a = rng.randint(0, 12)
            words[5:5] = i[a : a + rng.choice([6, 7, 8, 9, 14])]
        docs.append((k, rng.choice([" ", "​ ", ", ", "\n"]).join(w.upper() if rng.random() < 0.3 else w for w in words)))
    docs += [(500, None), (501, ""), (502, "Ｗ１ " * 3), (503, "long " * 50_000 + items[0][1])]

    def grams(t):
        import re
        import unicodedata

        w = re.findall(r"[^\W_]+", unicodedata.normalize("NFKC", (t or "").replace("​", "")).lower())
        return {tuple(w[i : i + 8]) for i in range(len(w) - 7)}

    want = {(d, i) for d, x in docs for i, y in items if grams(x) & grams(y)}
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    got = leaks.leaked(df, "doc_id", "text", spark.createDataFrame(items, "item_id long, text string"), "item_id", "text").collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want) > 10
    assert leaks.leaked(df.limit(0), "doc_id", "text", spark.createDataFrame(items, "item_id long, text string"), "item_id", "text").count() == 0


def test_mixing(spark):
    rng = random.Random(9)
    docs = [(i, s, "word " * rng.randint(1, 30)) for i, s in enumerate(rng.choices(["big", "mid", "tiny"], [0.85, 0.14, 0.01], k=3000))] + [(-1, None, "x"), (-2, "big", None), (-3, "mid", "")]
    t = spark.createDataFrame([("big", 0.4, 1, 1.0), ("mid", 0.4, 5, 1.0), ("tiny", 0.2, 2, 1.0), ("absent", 0.0, 2, 1.0)], "source string, target_share double, max_repeats int, budget_factor double")
    mixture, report = mixing.mix(spark.createDataFrame(docs, "doc_id long, source string, text string"), "doc_id", "source", "text", t, mixing.word_counts)
    rows, rep = mixture.collect(), {r.source: r for r in report.collect()}
    total = sum(len((x or "").split()) for _, s, x in docs if s and x is not None)
    assert total - 40 <= sum(r.size for r in rows) <= total
    assert max(collections.Counter((r.doc, r.copy) for r in rows).values()) == 1 and {r.copy for r in rows if r.source == "tiny"} == {0, 1}
    assert rep["tiny"].short and not rep["big"].short and not rep["mid"].short
    assert abs(rep["big"].actual_share - rep["mid"].actual_share) < 0.02 and rep["tiny"].actual_share < 0.05
    empty = mixing.mix(spark.createDataFrame([], "doc_id long, source string, text string"), "doc_id", "source", "text", t, mixing.word_counts)
    assert empty[0].count() == 0


def test_short_comes_from_the_queue(spark, monkeypatch):
    docs = spark.createDataFrame([(i, s, "w w") for i, s in enumerate("aaaaaaaabb")], "doc_id long, source string, text string")
    t = spark.createDataFrame([("a", 0.5, 1, 1.0), ("b", 0.5, 2, 1.0), ("absent", 0.1, 2, 1.0), ("off", 0.0, 1, 1.0)], "source string, target_share double, max_repeats int, budget_factor double")
    rep = {r.source: (r.last_finish, r.short) for r in mixing.mix(docs, "doc_id", "source", "text", t, mixing.word_counts)[1].collect()}
    assert rep == {"a": (32.0, False), "b": (16.0, True), "absent": (0.0, True), "off": (float("inf"), False)}
    real = mixing.running_sum
    monkeypatch.setattr(mixing, "running_sum", lambda df, keys, *a: real(df, keys, *a).where("source <> 'b' or not (size = upto)").withColumn("upto", F.col("upto") - F.when(F.col("source") == "b", 1).otherwise(0)) if keys else real(df, keys, *a))
    with pytest.raises(Exception, match="queue doesn't end"):  # a queue that loses documents is seen in the report
        mixing.mix(docs, "doc_id", "source", "text", t, mixing.word_counts)[1].collect()


def test_token_counts(spark):
    f = mixing.token_counts()
    got = [r.n for r in spark.createDataFrame([("hello world",), (None,), ("",), ("a" * 5000,)], "t string").select(f("t").alias("n")).collect()]
    assert got[0] == 2 and got[1] is None and got[2] == 0 and got[3] > 1


def test_both_tokenizer_formats_count_alike(spark):
    texts = ["Hello  world, it's 12:30!", "naïve 漢字 ", "<|endoftext|> x", "\n\n a"]
    sizes = [mixing._counter(p)(texts) for p in ("/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/byte_bpe_50k.tiktoken")]
    assert sizes[0] == sizes[1]


def test_the_unit_of_the_mixture_is_a_setting(spark, monkeypatch):
    from susurrus.llm import queries

    seen = []
    monkeypatch.setattr(queries, "UNITS", {"tokens": lambda: seen.append("tokens") or mixing.word_counts, "words": lambda: seen.append("words") or mixing.word_counts})
    queries._mix(spark, "/root/testdata/sf0.001")
    spark.conf.set("susurrus.mix.unit", "words")
    queries._mix(spark, "/root/testdata/sf0.001")
    spark.conf.unset("susurrus.mix.unit")
    assert seen == ["tokens", "words"]
