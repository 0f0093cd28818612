import math
import random

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry
from susurrus.llm import languages, topics

DATA = "/root/testdata/sf0.001"


def test_code_lengths_are_those_of_partial_matching():
    """The tables give the same bits as a plain recursive coder with dictionaries."""
    samples = [("the cat sat", 0), ("the hat", 0), ("el gato negro", 1), ("el gallo", 1)]
    trees = languages.Trees(samples)

    def bits(lang, text, i):
        data = [b"\n" + t.encode() for t, y in samples if y == lang]
        own = b"\n" + text.encode()
        total = 0.0
        for o in range(min(languages.ORDER, i), -1, -1):
            ctx = own[i - o : i]
            n = {}
            for d in data:
                for j in range(max(1, o), len(d)):
                    if d[j - o : j] == ctx:
                        n[d[j]] = n.get(d[j], 0) + 1
            if not n:
                continue
            all_ = sum(n.values()) + len(n)
            if own[i] in n:
                return total + math.log2(all_ / n[own[i]])
            total += math.log2(all_ / len(n))
        return total + 8.0

    for text in ("the gato", "zebra", "el hat"):
        data, start, _ = languages._bytes([text])
        got = trees.code_lengths(data, start)
        for lang in (0, 1):
            assert np.allclose(got[1:, lang], [bits(lang, text, i) for i in range(1, len(data))], atol=1e-3)


def test_best_path_against_brute_force():
    from itertools import product

    rng = np.random.default_rng(2)
    sizes = np.array([3, 1, 4])
    cost, change = rng.uniform(0, 5, (8, 3)), rng.uniform(0, 3, 8)
    got, at = languages.best_path(cost, change, sizes), 0
    for n in sizes:
        price = lambda p: sum(cost[at + k, x] for k, x in enumerate(p)) + sum(change[at + k] for k in range(1, n) if p[k] != p[k - 1])  # noqa: B023, E731
        assert math.isclose(price(tuple(got[at : at + n])), min(price(p) for p in product(range(3), repeat=n)))
        at += n


TEXTS = {
    "en": ["the sound of tapping the glass bottle", "rubbing the paper bag very slowly", "brushing the felt pad in the dark", "with both hands, folding the letters"],
    "es": ["el sonido de la botella de vidrio", "frotando la bolsa de papel muy despacio", "cepillando la almohadilla de fieltro", "con las dos manos, doblando las cartas"],
    "ru": ["тихий звук стеклянной бутылки", "складываю бумажный пакет очень медленно", "чищу щёткой подушку", "двумя руками складываю письма"],
    "ja": ["ガラスの瓶をたたく音", "紙の袋をなでる", "赤いノートをひらく音です", "両手で手紙をたたむ"],
}


def table(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(TEXTS[x]), x if rng.random() < 0.85 else rng.choice(list(TEXTS))) for i, x in enumerate(rng.choices(list(TEXTS), k=400))]
    rows += [
        (900, "the sound of the glass bottle | frotando la bolsa de papel", "en"), (901, "[ASMR] RUBBING THE PAPER BAG", "es"), (902, "♪ 4K 12:30", "en"), (903, None, "en"), (904, "", None), (905, "紙の袋をなでる", " und "),
        (906, "tapping the glass bottle " * 2000 + "両手で手紙をたたむ", "EN-us"), (907, "ASMR", "en"),
    ]
    rows += [(1000 + i, f"ASMR {rng.choice(TEXTS[x])}", x) for i, x in enumerate(list(TEXTS) * 10)]
    return spark.createDataFrame(rows, "line_id long, title string, lang string")


def test_runs(spark):
    got = {}
    for r in languages.language_runs(table(spark), "line_id", "title", "lang").orderBy("line_id", "run_no").collect():
        got.setdefault(r.line_id, []).append(r.lang)
        assert 0 < r.confidence <= 1
    truth = {t: x for x, ts in TEXTS.items() for t in ts}
    assert all(got[r.line_id] == [truth[r.title]] for r in table(spark).where("line_id < 400").collect())
    assert got[900] == ["en", "es"] and got[901] == ["en"] and got[905] == ["ja"] and got[906] == ["en", "ja"]
    assert not {902, 903, 904, 907} & set(got)


def test_runs_of_empty_and_unlabelled_tables(spark):
    t = table(spark)
    assert languages.language_runs(t.limit(0), "line_id", "title", "lang").count() == 0
    assert languages.language_runs(t.selectExpr("line_id", "title", "cast(null as string) lang"), "line_id", "title", "lang").count() > 0


def test_at_least_against_enumeration():
    rng = np.random.default_rng(3)
    r = rng.uniform(0, 1, (9, 2))
    got = topics.at_least(r, np.array([5, 0, 4]), 3)
    for doc, (a, b) in enumerate(((0, 5), (5, 5), (5, 9))):
        for c in range(2):
            p = [1.0]
            for x in r[a:b, c]:
                p = [(p[k] if k < len(p) else 0) * (1 - x) + (p[k - 1] * x if k else 0) for k in range(len(p) + 1)]
            assert math.isclose(got[doc, c], sum(p[3:]), abs_tol=1e-6)


NOUNS = {"nature": ["river", "owl", "moss", "fox"], "cooking": ["noodle", "broth", "pepper", "dough"], "craft": ["chisel", "yarn", "varnish", "kiln"]}
PLAIN = ["Thanks for staying until the end.", "This took longer than planned.", "See the list below."]


def corpus(n=600, seed=1):
    rng = random.Random(seed)
    docs, truth = [], {}
    for i in range(n):
        areas = rng.sample(sorted(NOUNS), rng.choice([0, 1, 1, 2]))
        s = [f"The {rng.choice(NOUNS[a])} was near the {rng.choice(NOUNS[a])} again." for a in areas for _ in range(4)] + [rng.choice(PLAIN) for _ in range(4)]
        if rng.random() < 0.3:
            s.append(f"The {rng.choice(NOUNS['craft'])} is mentioned once.")
        rng.shuffle(s)
        docs.append((i, " ".join(s), "en"))
        truth[i] = {a for a in areas if 4 >= 3}
    return docs, truth


def test_areas(spark):
    docs, truth = corpus()
    rng = random.Random(2)
    labels = [(i, a) for i in range(120) for a in (truth[i] if rng.random() > 0.05 else {rng.choice(sorted(NOUNS))})] + [(None, "nature"), (5, None), (99_999, "craft")]
    odd = [(2000, None, "en"), (2001, "", "en"), (2002, "12:30 the fox and the owl\n0:45 the river and the moss\n1:00 the owl and the fox", None), (2003, "word " * 100_000, "xx"), (2004, "!!!", "en")]
    df = spark.createDataFrame(docs + odd, "doc_id long, text string, lang string").selectExpr("*", "'clash' as area")
    got = {}
    for r in topics.areas(df, "doc_id", "text", spark.createDataFrame(labels, "doc_id long, area string"), "area", "lang").collect():
        got.setdefault(r.doc_id, set()).add(r.area)
    held = range(120, 600)
    assert sum(got.get(i, set()) == truth[i] for i in held) / len(held) > 0.95
    assert not {2000, 2001, 2002, 2003, 2004} & set(got)
    none = spark.createDataFrame([], "doc_id long, area string")
    assert topics.areas(df, "doc_id", "text", none, "area").count() == 0
    assert topics.areas(df.limit(0), "doc_id", "text", spark.createDataFrame(labels, "doc_id long, area string"), "area").count() == 0


def test_problem_queries_have_the_given_columns(spark):
    want = {
        "p1_found": ["line_id", "run_no", "lang"], "p2_found": ["group_id", "id"], "p3_found": ["src", "video_id", "kind", "from_ms", "to_ms"], "p4_found": ["scope", "category"], "p5_found": ["label_id", "field_name", "group_id"], "p6_found": ["item_id", "verb", "object"],
        "p7_found": ["table_name", "row_key", "field_name", "pos", "val"], "p8_found": ["doc_id", "item_id"], "p9_found": ["source"], "p10_found": ["doc_id", "area"],
    }
    for name, cols in want.items():
        df = entry.queries()[name](spark, DATA)
        assert df.columns == cols and df.count() >= 0


def test_language_sample_takes_distinct_titles(spark):
    rows = [(f"title number {i}", "en") for i in range(100) for _ in range(100)] + [("der Titel", "de")] * 500 + [(None, "en"), ("untold", None)]
    got = languages.sample(spark.createDataFrame(rows, "t string, l string"), "t", "l", 50)
    en = [r["text"] for r in got if r["lang"] == "en"]
    assert len(en) == len(set(en)) == 50 and [r["text"] for r in got if r["lang"] == "de"] == ["der Titel"]


def test_areas_count_long_documents_in_full(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "Tap glass softly. " * 500), (2, "Brush hair slowly. " * 20), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, "tap"), (2, "brush")], "doc_id long, area string")
    seen, real = [], topics.pooled_log
    monkeypatch.setattr(topics, "pooled_log", lambda n: seen.append(n.sum()) or real(n))
    topics.areas(docs, "doc_id", "text", labels, "area", rounds=1)
    assert len(seen) == 1 and abs(seen[0] - 520 * 3) < 1e-2


def test_areas_are_fitted_on_all_documents(spark, monkeypatch):
    """More than a million documents, each of whose words counts in a round."""
    n = 1_030_000
    docs = spark.range(n).selectExpr("id as doc_id", "if(id % 2 = 0, 'Tap glass', 'Brush hair') as text")
    labels = spark.createDataFrame([(0, "tap"), (1, "brush")], "doc_id long, area string")
    seen, real = [], topics.pooled_log
    monkeypatch.setattr(topics, "pooled_log", lambda x: seen.append(x.sum()) or real(x))
    topics.areas(docs, "doc_id", "text", labels, "area", rounds=1)
    assert len(seen) == 1 and abs(seen[0] - 2 * n) < 1


def test_calibration_takes_all_held_documents(spark):
    """The fit of 30,000 documents has no slope left over all of them; no documents leave the posteriors as they are."""
    rng = np.random.default_rng(3)
    x = rng.normal(0, 4, (30_000, 2))
    y = rng.random(x.shape) < 1 / (1 + np.exp(-(np.array([0.4, 1.7]) * x + [-2, 1])))
    z = 1 / (1 + np.exp(-x))
    rows = spark.createDataFrame([([k + 1 for k in range(2) if b[k]], a.tolist()) for a, b in zip(z, y, strict=True)], "`all` array<int>, z array<double>")
    for k, (slope, shift) in enumerate(topics.calibrations(rows, 2)):
        odds = np.clip(np.log(z[:, k] / (1 - z[:, k])), -12, 12)
        miss = 1 / (1 + np.exp(-(slope * odds + shift))) - y[:, k]
        assert abs((miss * odds).sum() + 5 * (slope - 1)) < 1e-3 and abs(miss.sum() + 5 * shift) < 1e-3
    assert topics.calibrations(rows.limit(0), 2) == [(1.0, 0.0)] * 2


def test_unsure_runs_go_to_a_neighbour():
    """Every word from the first that is told on is in one run, also where a run in the middle is unsure."""
    rng = np.random.default_rng(7)
    cost = rng.uniform(0, 30, (9, len(languages.LANGUAGES)))
    sums = np.concatenate([np.zeros((1, cost.shape[1])), np.cumsum(cost, 0)])
    got = languages._merged([(0, 0, 3, 0.9), (1, 3, 2, 0.3), (2, 5, 4, 0.8)], sums)
    assert sum(n for _, _, n, _ in got) == 9 and [a for _, a, _, _ in got] == list(np.cumsum([0] + [n for _, _, n, _ in got])[:-1])
    mid = cost[3:5].sum(0)
    assert [r[0] for r in got] == [0, 2] and got[0][2] == (5 if mid[0] < mid[2] else 3)
    for lang, a, n, c in got:
        own = cost[a : a + n].sum(0)
        share = np.exp2(-np.clip(own - own.min(), 0, 60) / languages.TEMPERATURE)
        assert math.isclose(c, share[lang] / share.sum())
    # an unsure run between two of one language leaves one run, and the only run stays whatever its confidence
    assert [r[:3] for r in languages._merged([(4, 0, 2, 0.9), (1, 2, 1, 0.2), (4, 3, 6, 0.9)], sums)] == [(4, 0, 9)]
    assert languages._merged([(4, 0, 2, 0.1), (1, 2, 7, 0.2)], sums)[0][:3] == (1, 0, 9)


def test_runs_in_any_batch_are_those_of_single_texts():
    texts = [t for ts in TEXTS.values() for t in ts]
    langs = [x for x, ts in TEXTS.items() for _ in ts]
    trees, neutral = languages.fit(texts, langs)
    odd = ["", "  ", "♪ 4K", "x\ny", "the glass bottle | el sonido de la botella — ガラスの瓶をたたく音", "Ｔｈｅ　ＧＬＡＳＳ", "e\u0301l gato\u200b", "a" * 3000]
    whole = languages.runs_of(texts + odd, trees, neutral)
    for t, r in zip(texts + odd, whole, strict=True):
        one = languages.runs_of([t], trees, neutral)[0]
        assert [x[:3] for x in one] == [x[:3] for x in r] and np.allclose([x[3] for x in one], [x[3] for x in r])
    assert [x[0] for x in whole[len(texts) + 4]] == ["en", "es", "ja"]


def test_areas_hidden_labels_and_a_bounded_sample(spark):
    """Recall and precision on documents whose labels were hidden, with the rounds on a sample of the documents too."""
    docs, truth = corpus(800, 3)
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, a) for i in range(200) for a in truth[i]], "doc_id long, area string")
    for em_rows in (1_000_000, 300):
        got = {(r.doc_id, r.area) for r in topics.areas(df, "doc_id", "text", labels, "area", "lang", em_rows=em_rows).collect()}
        want = {(i, a) for i, xs in truth.items() for a in xs}
        hidden = lambda x: {y for y in x if y[0] >= 200}
        hit = len(hidden(got) & hidden(want))
        assert hit / len(hidden(want)) > 0.95 and hit / len(hidden(got)) > 0.95


def test_every_common_language_has_its_weights(spark):
    """More than six languages, each with its own words for the areas."""
    rng = random.Random(4)
    nouns = {(lang, a): [f"{a}{lang}{k}".translate(str.maketrans("0123456789", "abcdefghij")) for k in range(6)] for lang in range(8) for a in ("tap", "brush")}
    docs, truth = [], {}
    for i in range(960):
        lang, areas = i % 8, [[], ["tap"], ["brush"]][i // 8 % 3]
        s = [f"{rng.choice(nouns[lang, a])} la{'xyzuvwqp'[lang]} {rng.choice(nouns[lang, a])}." for a in areas for _ in range(4)] + [f"no{'xyzuvwqp'[lang]} da{'xyzuvwqp'[lang]}."] * 3
        docs.append((i, " ".join(s), "abcdefgh"[lang] * 2))
        truth[i] = set(areas)
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, a) for i in range(480) for a in truth[i]], "doc_id long, area string")
    got = {}
    for r in topics.areas(df, "doc_id", "text", labels, "area", "lang").collect():
        got.setdefault(r.doc_id, set()).add(r.area)
    assert sum(got.get(i, set()) == truth[i] for i in range(480, 960)) > 0.95 * 480


def test_long_tags_are_markup(spark):
    df = spark.createDataFrame([(f"<a href='{'x' * 5000}'>One tap. </a>Two<br>Three",)], "t string")
    assert [x.strip() for x in df.select(topics.sentences(F.col("t")).alias("s")).first().s if x.strip()] == ["One tap.", "Two", "Three"]
