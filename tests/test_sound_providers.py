import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from susurrus.operators import audio, embeddings, providers, segmentation


def test_features_of_known_sounds():
    rate, t = 8000, np.arange(8000) / 8000
    tone, noise = 0.5 * np.sin(2 * np.pi * 1000 * t), np.random.default_rng(0).normal(0, 0.1, 8000)
    x, n = audio.sound_features(tone, rate), audio.sound_features(noise, rate)
    assert x.shape == (1 + 8000 // 128, 76) == n.shape and audio.sound_features(np.zeros(0), rate).shape == (0, 76)
    mid = x[20:-20]
    names = {"flatness": 67, "crossings": 68, "rms": 69, "center": 70, "roll": 72}
    assert np.allclose(mid[:, names["center"]], 1000, atol=15) and np.allclose(mid[:, names["roll"]], 1000, atol=15) and np.allclose(mid[:, names["rms"]], 0.5 / math.sqrt(2), atol=0.01)
    assert np.allclose(mid[:, names["crossings"]], 2 * 1000 / rate, atol=0.01) and mid[:, names["flatness"]].max() < 0.01 < n[20:-20, names["flatness"]].min()
    assert np.isfinite(x).all() and np.isfinite(audio.sound_features(np.zeros(2000), rate)).all()


def test_cepstrum_and_slopes():
    power = np.random.default_rng(1).uniform(0.1, 1, (4, 513))
    c = audio.cepstrum(power, 16000, 1024, 20)
    db = 10 * np.log10(power @ audio.mel_bands(16000, 1024).T)
    # the whole transform is orthonormal: it keeps the length
    assert np.allclose((audio.cepstrum(power, 16000, 1024, 128) ** 2).sum(1), (db**2).sum(1)) and np.allclose(c[:, 0], db.sum(1) / math.sqrt(128))
    assert np.allclose(audio.slope(np.outer(np.arange(30), [2.0, -1.0])), [2.0, -1.0]) and (audio.slope(np.ones((4, 2))) == 0).all()
    bands = audio.mel_bands(16000, 1024, 40)
    assert bands.shape == (40, 513) and (bands >= 0).all() and (bands.argmax(1)[1:] >= bands.argmax(1)[:-1]).all()


def test_window_statistics_against_loops():
    x = np.random.default_rng(2).normal(0, 1, (50, 3))
    c, v = audio.window_statistics(x, 8, 5)
    assert list(c) == [k + 4 for k in range(0, 43, 5)]
    for row, k in zip(v, range(0, 43, 5), strict=True):
        assert np.allclose(row, np.concatenate([x[k : k + 8].mean(0), np.sqrt(x[k : k + 8].var(0) + 1e-8)]))
    assert len(audio.window_statistics(x[:3], 8, 5)[0]) == 0


def sound(rate=4000):
    t, rng = np.arange(20 * rate) / rate, np.random.default_rng(3)
    return np.concatenate([0.4 * np.sin(2 * np.pi * 500 * t) * (1 + 0.1 * np.sin(9 * t)), rng.normal(0, 0.2, len(t))]), rate


def test_a_change_of_texture_is_cut(spark):
    y, rate = sound()
    parts = audio.cut_sound(y, rate, 100.0, 140.0, size=256, hop=64, penalty=3.0)
    assert len(parts) == 2 and parts[0][0] == 100.0 and parts[1][1] == 140.0 and abs(parts[0][1] - 119) < 1.5 and abs(parts[1][0] - parts[0][1] - 2) < 1e-9 and all(k for *_, k in parts)
    with pytest.raises(ValueError, match="empty"):
        audio.cut_sound(np.zeros(0), rate, 0, 1)
    assert list(audio.left_slice(np.arange(10.0)[:, None], 1, 2.5, 4.2)) == [2, 3, 4] and len(audio.left_slice(np.zeros((5, 1)), 1, 7, 9)) == 0
    lines = spark.createDataFrame([("v", 0.0, 40.0), ("v", 1.0, 2.0), ("v", 50.0, 60.0), ("bad", 0.0, 5.0), ("none", 0.0, 5.0), ("v", None, 5.0)], "id string, a double, b double")
    sounds = spark.createDataFrame([("v", bytearray(audio.encode(y[:, None], rate))), ("bad", bytearray(b"no"))], "id string, content binary")
    got = [tuple(r) for r in audio.cut_videos(lines, sounds, "id", "a", "b", "content", size=256, hop=64, penalty=3.0).orderBy("id", "start", "clean_start").collect()]
    assert [g[-1] for g in got] == ["unreadable sound", "no sound", None, None, "no window fits", "empty segment"] and got[0][3:5] == (0.0, 5.0)


def test_binary_cuts(spark):
    rng = np.random.default_rng(0)
    v = np.concatenate([rng.normal(m, 0.2, 30) for m in (0, 4, 0)])[:, None]
    assert segmentation.binary_rbf(v, 2, 5) == [30, 60, 90] and segmentation.binary_rbf(v[:6], 3, 5) == [6] and segmentation.binary_rbf(v, 0) == [90]
    df = spark.createDataFrame([("k", i, float(x)) for i, x in enumerate(v[:, 0])], "k string, i int, x double")
    for method in ("pelt", "kernel", "binary"):
        assert [r["last"] for r in segmentation.change_points(df, "k", ["i"], ["x"], method=method, cuts=2).orderBy("segment").collect()] == [29, 59, 89]
    with pytest.raises(ValueError):
        segmentation.change_points(df, "k", ["i"], ["x"], method="binary")


def test_distributions(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, [3.0, 1.0, 0.0])], "k int, v array<double>")
    p = df.select("k", embeddings.softmax(F.col("v")).alias("p"))
    soft = lambda v: np.exp(v) / np.exp(v).sum()
    a, b = soft(np.array([1.0, 2, 3])), soft(np.array([3.0, 1, 0]))
    kl = lambda x, y: float((x * np.log(x / y)).sum())
    m = (a + b) / 2
    assert math.isclose(embeddings.inception_score(p, "p").first().score, math.exp((kl(a, m) + kl(b, m)) / 2))
    assert math.isclose(embeddings.paired_divergence(p, p.withColumn("k", 3 - F.col("k")), "k", "p").first().divergence, (kl(a, b) + kl(b, a)) / 2)


def test_retries_and_failover():
    waits, calls = [], []

    def fails(x):
        calls.append(x)
        if len(calls) < 3:
            raise OSError("connection reset")
        return "ok"

    assert providers.with_retry(fails, 3, 0.5, 2.0, sleep=waits.append)("q") == "ok" and waits == [0.5, 1.0]
    with pytest.raises(OSError):
        providers.with_retry(lambda x: (_ for _ in ()).throw(OSError("denied")), 3, passing=providers.is_transient)("q")

    def out(x):
        raise RuntimeError("insufficient_quota")

    chain = providers.with_failover({"a": out, "b": lambda x: "b", "c": lambda x: "c"}, ["a", "a", "zz", "b", "c"])
    assert chain("q") == "b"
    with pytest.raises(RuntimeError):
        providers.with_failover({"a": out}, ["a"])("q")
    with pytest.raises(ValueError):
        providers.with_failover({}, ["a"])


def test_replies_of_a_provider(spark):
    def call(p):
        if p == "boom":
            raise OSError("gone")
        return ('```json\n{"verb": "tap"}\n```' if p == "good" else "no json", 3, 1)

    df = spark.createDataFrame([(1, "good"), (2, "bad"), (3, "boom"), (4, None)], "k int, p string")
    got = {r.k: (r.answer and r.answer.verb, r.error, r.prompt_tokens) for r in providers.ask(df, "k", "p", call, "verb string", retries=1).collect()}
    assert got == {1: ("tap", None, 3), 2: (None, "the reply is no JSON object", 3), 3: (None, "gone", 0)}
