"""Language of each text and of each run within it: prediction by partial matching over bytes, under frozen statistics."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.timelines import first_by

#: The languages told apart.
LANGUAGES = ["en", "es", "pt", "de", "fr", "it", "ru", "ja", "ko", "zh"]
#: Labelled texts used to fit: distinct texts per declared language, by hash order, and the characters up to which a text
#: is used to fit (longer texts are scored whole, but don't enter the trees). The two bound the trees.
FIT_ROWS, FIT_CHARS = 2_000, 2_000
ORDER = 5
#: Bits that a change of language costs between words, and across a separator.
SWITCH, SWITCH_AT_MARK = 16.0, 9.0
#: Bits that halve the weight of a language in a confidence: bytes of a word are not independent.
TEMPERATURE = 3.0

_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_MARK = re.compile(r"[^\w\s,'’、，]|\n")
_PIECE = re.compile(r"[/|~・\n\r\t【】()（）\[\]:：]+|\s-\s")


_BLANKS = re.compile(r"[^\S\n]+")


def plain(text: str) -> str:
    """Narrow, composed, in lower case, blanks squeezed; line breaks stay as marks."""
    if text.isascii() and text.isprintable():
        return _BLANKS.sub(" ", text.lower()).strip()
    x = unicodedata.normalize("NFKC", text).casefold().replace("ß", "ss")
    return _BLANKS.sub(" ", x if x.isprintable() else "".join(c for c in x if unicodedata.category(c) != "Cf")).strip()


def word_spans(x: str) -> list[tuple[int, int]]:
    """Places of the words of a plain text: runs of letters, beside which no digit stands (a mark like 4k is no word)."""
    return [(m.start(), m.end()) for m in _WORD.finditer(x) if not (x[m.start() - 1 : m.start()].isdigit() or x[m.end() : m.end() + 1].isdigit())]


def features(x: str) -> list[str]:
    """Words, and the single letters of words that aren't Latin."""
    out: list[str] = []
    for a, b in word_spans(x):
        w = x[a:b]
        out += [w] if all("LATIN" in unicodedata.name(c, "") or c in "'’" for c in w) else list(w)
    return out


def cleaned(texts: list[str], langs: list[int], rounds: int = 3, smooth: float = 0.2) -> list[tuple[str, int]]:
    """(piece, language): the pieces of the labelled texts between separators, relabelled by naive Bayes.

    Labels are missing or wrong for a part of the texts and pieces of a text differ in language, so labels are re-estimated
    from the words: each round gives every piece its most likely language under counts of the labels of the round before.
    """
    pieces = [(p.strip(), y) for x, y in zip(texts, langs, strict=True) for p in _PIECE.split(x) if p.strip()]
    names: dict[str, int] = {}
    rows = [[names.setdefault(f, len(names)) for f in features(p)] for p, _ in pieces]
    keep = [k for k, r in enumerate(rows) if r]
    if not keep:
        return []
    flat = np.concatenate([rows[k] for k in keep])
    at = np.repeat(np.arange(len(keep)), [len(rows[k]) for k in keep])
    y = np.array([pieces[k][1] for k in keep])
    n_lang = len(LANGUAGES)
    for _ in range(rounds):
        known = y[at] >= 0
        n = np.bincount(y[at][known] * len(names) + flat[known], minlength=n_lang * len(names)).reshape(n_lang, -1).astype(float)
        # shares of a word among the languages, each language weighing the same; wrong labels are spread over all
        rate = (n + smooth * n.sum(0) / n.sum()) / (n.sum(1, keepdims=True) + smooth)
        w = np.log(rate / rate.sum(0) + 0.03)
        score = np.column_stack([np.bincount(at, x[flat], minlength=len(keep)) for x in w])
        y = score.argmax(1)
    top = np.sort(score, 1)
    sure = top[:, -1] - top[:, -2] > 1.0
    return [(pieces[k][0], int(y[j])) for j, k in enumerate(keep) if sure[j]]


def _hashes(data: np.ndarray, start: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    """For the orders 0..ORDER: hash of the context of each byte, hash of context and byte, and whether the context lies
    inside the text. `start` is the first byte of each byte's text."""
    d = data.astype(np.uint64) + np.uint64(1)
    pos = np.arange(len(d))
    mul = np.uint64(0x9E3779B97F4A7C15)
    ctx = [np.zeros(len(d), np.uint64)]
    ok = [np.ones(len(d), bool)]
    with np.errstate(over="ignore"):
        for o in range(1, ORDER + 1):
            # context of order o: that of order o - 1, and the byte o places back
            far = np.concatenate([np.zeros(o, np.uint64), d[:-o]]) if len(d) > o else np.zeros(len(d), np.uint64)
            h = (ctx[-1] * np.uint64(257) + far) * mul
            ctx.append(h ^ (h >> np.uint64(29)))
            ok.append(pos - o >= start)
        keys = []
        for c in ctx:
            h = (c * np.uint64(263) + d + np.uint64(7)) * mul
            keys.append(h ^ (h >> np.uint64(31)))
    return ctx, keys, ok


def _bytes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Bytes of the texts, each led by a line break, and the first place of each byte's text."""
    raw = [b"\n" + t.encode() for t in texts]
    sizes = np.array([len(x) for x in raw], int)
    start = np.repeat(np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) if raw else np.zeros(0, int)
    return np.frombuffer(b"".join(raw), np.uint8), start, raw


class Trees:
    """Context trees of all languages as sorted tables: per order the code length of every known (context, byte) in each
    language, escapes to shorter contexts included, and the escape length of every known context in each language."""

    def __init__(self, samples: list[tuple[str, int]]) -> None:
        n_lang = len(LANGUAGES)
        seen: list[list] = [[] for _ in range(ORDER + 1)]
        for lang in range(n_lang):
            data, start, _ = _bytes([t for t, y in samples if y == lang])
            ctx, keys, ok = _hashes(data, start)
            for o in range(ORDER + 1):
                use = ok[o] & (np.arange(len(data)) > start)
                low = keys[o - 1][use] if o else keys[0][use]
                k, first, n = np.unique(keys[o][use], return_index=True, return_counts=True)
                seen[o].append((k, ctx[o][use][first], low[first], n))
        self.keys, self.cost, self.ctx, self.escape = [], [], [], []
        for o in range(ORDER + 1):
            key = np.unique(np.concatenate([s[0] for s in seen[o]]))
            cs = np.unique(np.concatenate([s[1] for s in seen[o]]))
            low = np.zeros(len(key), np.uint64)
            own = np.full((len(key), n_lang), np.nan)
            of = np.zeros(len(key), int)
            esc = np.zeros((len(cs), n_lang))
            for lang, (k, c, lo, n) in enumerate(seen[o]):
                at, ci = np.searchsorted(key, k), np.searchsorted(cs, c)
                low[at], of[at] = lo, ci
                total, kinds = np.bincount(ci, n, minlength=len(cs)), np.bincount(ci, minlength=len(cs))
                own[at, lang] = np.log2((total + kinds)[ci] / n)
                esc[:, lang] = np.where(kinds > 0, np.log2(np.maximum(total + kinds, 1) / np.maximum(kinds, 1)), 0)
            below = self.cost[o - 1][np.searchsorted(self.keys[o - 1], low)] if o else np.full((len(key), n_lang), 8.0)
            cost = np.where(np.isnan(own), esc[of] + below, own)
            self.keys.append(key)
            self.cost.append(cost.astype(np.float32))
            self.ctx.append(cs)
            self.escape.append(esc.astype(np.float32))

    def code_lengths(self, data: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Bits of each byte in each language."""
        ctx, keys, ok = _hashes(data, start)
        out = np.zeros((len(data), len(LANGUAGES)), np.float32)
        open_ = np.ones(len(data), bool)
        for o in range(ORDER, -1, -1):
            if not len(self.keys[o]):
                continue
            todo = np.flatnonzero(open_ & ok[o])
            at = np.minimum(np.searchsorted(self.keys[o], keys[o][todo]), len(self.keys[o]) - 1)
            hit = self.keys[o][at] == keys[o][todo]
            out[todo[hit]] += self.cost[o][at[hit]]
            open_[todo[hit]] = False
            miss = todo[~hit]
            at = np.minimum(np.searchsorted(self.ctx[o], ctx[o][miss]), len(self.ctx[o]) - 1)
            known = self.ctx[o][at] == ctx[o][miss]
            out[miss[known]] += self.escape[o][at[known]]
        out[open_] += 8.0
        return out


def fit(texts: list[str], langs: list[str | None], rounds: int = 1) -> tuple[Trees, set[str]]:
    """Trees and the neutral words (names and abbreviations that stand in texts of all languages) from labelled texts."""
    number = {x: k for k, x in enumerate(LANGUAGES)}
    plains = [plain(t) for t in texts]
    ys = [number.get(x, -1) for x in langs]
    samples = cleaned(plains, ys)
    trees = Trees(samples)
    for _ in range(rounds):
        data, start, raw = _bytes([t for t, _ in samples])
        if not len(data):
            break
        sizes = np.array([len(x) for x in raw])
        bits = np.add.reduceat(trees.code_lengths(data, start), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
        samples = [(t, int(k)) for (t, _), k in zip(samples, bits.argmin(1), strict=True)]
        trees = Trees(samples)
    # by the declared languages of whole texts: a piece of its own, like "[ASMR]", has no language that could be told
    seen: dict[str, np.ndarray] = {}
    known = [y for y in ys if y >= 0]
    size = np.maximum(np.bincount(known, minlength=len(LANGUAGES)) if known else np.ones(len(LANGUAGES)), 1)
    for t, y in zip(plains, ys, strict=True):
        if y >= 0:
            for w in {t[a:b] for a, b in word_spans(t)}:
                seen.setdefault(w, np.zeros(len(LANGUAGES)))[y] += 1 / size[y]
    return trees, {w for w, n in seen.items() if n.max() < 0.4 * n.sum() and (n > 0).sum() >= max(4, 0.7 * len(set(known)))}


def best_path(cost: np.ndarray, change: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Cheapest language of each word (words x languages costs of texts one after another; `change` before each word)."""
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    path = np.zeros(len(cost), int)
    order = np.argsort(-sizes, kind="stable")
    longest = int(sizes.max()) if len(sizes) else 0
    back = np.zeros(cost.shape, np.int8)
    now = np.zeros((len(sizes), cost.shape[1]))
    for k in range(longest):
        live = order[: int(np.searchsorted(-sizes[order], -k, side="left"))]
        at = first[live] + k
        if k:
            jump = now[live].argmin(1)
            by_jump = now[live, jump][:, None] + change[at][:, None]
            stay = now[live] <= by_jump
            back[at] = np.where(stay, np.arange(cost.shape[1]), jump[:, None])
            now[live] = np.where(stay, now[live], by_jump)
        now[live] += cost[at]
    for k in range(longest - 1, -1, -1):
        live = order[: int(np.searchsorted(-sizes[order], -k, side="left"))]
        at = first[live] + k
        last = sizes[live] - 1 == k
        path[at[last]] = now[live[last]].argmin(1)
        path[at[~last]] = back[at[~last] + 1, path[at[~last] + 1]]
    return path


def _words(text: str) -> tuple[np.ndarray, np.ndarray]:
    """First and end places of the words of a plain text (see `word_spans`)."""
    spans = word_spans(text)
    return np.array([a for a, _ in spans], int), np.array([b for _, b in spans], int)


def runs_of(texts: list[str], trees: Trees, neutral: set[str]) -> list[list[tuple[str, int, int, float]]]:
    """Per text its runs (language, first word, words, confidence). Words that are neutral, and everything that is no word,
    open no run; a text without other words has none. Every word from the first that isn't neutral on is in one run.

    All texts are worked on at once: they are joined by line breaks, which no word crosses, and places of words, marks and
    bytes are looked up in arrays of the joined text.
    """
    out: list[list[tuple[str, int, int, float]]] = [[] for _ in texts]
    plains = [plain(t) for t in texts]
    joined = "\n" + "\n".join(plains)
    lo, hi = _words(joined)
    if not len(lo):
        return out
    heavy = np.array([joined[a:b] not in neutral for a, b in zip(lo.tolist(), hi.tolist(), strict=True)])
    ends = np.cumsum([len(x) + 1 for x in plains])
    of = np.searchsorted(ends, lo, side="right")
    told = np.bincount(of[heavy], minlength=len(texts)) > 0
    use = told[of]
    lo, hi, heavy, of = lo[use], hi[use], heavy[use], of[use]
    if not len(lo):
        return out
    # the texts that are told, one after another, as bytes; where each character of the joined text begins in them
    keep = np.flatnonzero(told)
    data, start, raw = _bytes([plains[k] for k in keep])
    begin = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    chars = np.array([len(plains[k]) + 1 for k in keep])
    shift = np.zeros(len(texts), int)
    shift[keep] = np.concatenate([[0], np.cumsum(chars)[:-1]]) - (ends[keep] - chars)
    total = np.zeros((len(data) + 1, len(LANGUAGES)))
    np.cumsum(trees.code_lengths(data, start), 0, dtype=np.float64, out=total[1:])
    cost = total[begin[hi + shift[of]]] - total[begin[lo + shift[of]]]
    cost = np.where(heavy[:, None], cost - cost.min(1, keepdims=True), 0.0)
    marks = np.zeros(len(joined) + 1, int)
    marks[[m.start() + 1 for m in _MARK.finditer(joined)]] = 1
    marks = marks.cumsum()
    before = np.concatenate([[0], hi[:-1]])
    change = np.where(marks[lo] > marks[before], SWITCH_AT_MARK, SWITCH)
    sizes = np.bincount(of, minlength=len(texts))[keep]
    path = best_path(cost, change, sizes)

    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    at = np.flatnonzero(heavy)
    opens = np.ones(len(at), bool)
    opens[1:] = (path[at[1:]] != path[at[:-1]]) | (of[at[1:]] != of[at[:-1]])
    heads = at[opens]
    tails = np.append(at[np.flatnonzero(opens)[1:] - 1], at[-1]) + 1
    sums = np.concatenate([np.zeros((1, cost.shape[1])), np.cumsum(cost, 0)])
    sure = _confidence(sums[tails] - sums[heads], path[heads])
    place = first[np.searchsorted(keep, of[heads])]
    for text, lang, a, b, c, f in zip(of[heads].tolist(), path[heads].tolist(), heads.tolist(), tails.tolist(), sure.tolist(), place.tolist(), strict=True):
        out[text].append((lang, a - f, b - a, c))
    for text, f in zip(keep.tolist(), first.tolist(), strict=True):
        if len(out[text]) > 1:
            out[text] = _merged(out[text], sums[f:])
        out[text] = [(LANGUAGES[r[0]], *r[1:]) for r in out[text]]
    return out


def _confidence(bits: np.ndarray, lang: np.ndarray) -> np.ndarray:
    """Share of the language among all, bits (runs x languages) weighing as 2^(-bits / TEMPERATURE)."""
    share = np.exp2(-np.clip(bits - bits.min(1, keepdims=True), 0, 60) / TEMPERATURE)
    return share[np.arange(len(lang)), lang] / share.sum(1)


def _merged(runs: list[tuple[int, int, int, float]], sums: np.ndarray) -> list[tuple[int, int, int, float]]:
    """Runs of one text (language, first word, words, confidence) where those that no language explains better than the
    others together have gone to a neighbour, the one whose language their words cost less, and neighbours of one language
    are one. Words are lost to none; confidences are those of the whole runs. `sums` are running costs of the words."""
    bits = lambda a, b: sums[b] - sums[a]
    sure = [k for k, r in enumerate(runs) if r[3] >= 0.5] or [max(range(len(runs)), key=lambda k: runs[k][3])]
    langs = []
    for k, (lang, a, n, _) in enumerate(runs):
        if k not in sure:
            near = [max((j for j in sure if j < k), default=None), min((j for j in sure if j > k), default=None)]
            lang = min((runs[j][0] for j in near if j is not None), key=lambda x: bits(a, a + n)[x])
        langs.append(lang)
    out: list[tuple[int, int, int]] = []
    for lang, (_, a, n, _) in zip(langs, runs, strict=True):
        if out and out[-1][0] == lang:
            out[-1] = (lang, out[-1][1], a + n - out[-1][1])
        else:
            out.append((lang, a, n))
    lang, a, n = (np.array(x) for x in zip(*out, strict=True))
    return [(*r, c) for r, c in zip(out, _confidence(sums[a + n] - sums[a], lang).tolist(), strict=True)]


def primary(lang):
    """The part of a language tag before `-` or `_`, in lower case; null for null, blank and `und`."""
    x = F.lower(F.regexp_extract(F.col(lang), r"(?U)^\s*([^-_\s]*)", 1))
    return F.when((x != "") & (x != "und"), x)


def sample(rows: DataFrame, text: str, lang: str, per_language: int = FIT_ROWS) -> list:
    """Up to `per_language` distinct labelled texts of each language, by hash order, of up to FIT_CHARS characters.

    Languages are counted once; texts beyond twice the wanted share of their language by hash are thinned before the
    shuffle, and one window over (language, hash) takes the first of each."""
    x = rows.select(F.col(text).alias("text"), primary(lang).alias("lang")).where(F.col("text").isNotNull() & F.col("lang").isin(LANGUAGES) & (F.length("text") <= FIT_CHARS))
    h = F.xxhash64("text", F.lit(1))
    # distinct hashes stand for distinct texts in the counts, which only set how much is thinned
    n = {r["lang"]: r["n"] for r in x.groupBy("lang").agg(F.approx_count_distinct(h, 0.02).alias("n")).collect()}
    if not n:
        return []
    chance = F.create_map(*[F.lit(v) for k, m in n.items() for v in (k, min(1.0, 2 * per_language / m))])
    # copies of a text share their hash, so thinning before the copies go keeps the same texts
    thin = x.withColumn("h", h).where(F.pmod(F.col("h"), F.lit(1_000_003)) < chance[F.col("lang")] * 1_000_003).distinct()
    return first_by(thin, ["lang"], ["h", "text"], per_language).orderBy("lang", "h", "text").select("text", "lang").collect()


def language_runs(rows: DataFrame, key: str, text: str, lang: str, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Rows (key, declared, run_no, lang, first_word, words, confidence, runs): one a run of one language of each text.

    Per language, variable-order context trees over bytes, with escapes by the number of kinds of bytes seen, are fitted
    on at most `fit_rows` distinct labelled texts of up to FIT_CHARS characters per declared language (relabelled first,
    since labels may be wrong and texts mixed) and then frozen. Code lengths of every byte in every language are exact; words take the cheapest languages
    under a price for changes, less at separators. All texts are read whole, whatever the sample.

    Null, blank and wordless texts have no runs; a null or unknown declared language doesn't matter for the result; words
    that occur alike in the texts of many languages (names, abbreviations), numbers and marks belong to the run around
    them; repeated rows each give their runs. Without any labelled text every text falls to the first language.
    """
    spark = rows.sparkSession
    got = sample(rows, text, lang, fit_rows)
    trees, neutral = fit([r["text"] for r in got], [r["lang"] for r in got])
    model = spark.sparkContext.broadcast((vars(trees), neutral))  # plain arrays; bounded by the fitted texts
    base = rows.select(F.col(key).alias("key"), F.col(text).alias("text"), primary(lang).alias("declared")).where(F.col("text").isNotNull())
    kinds = dict(base.dtypes)

    def find(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables, neutral = model.value
        trees = Trees.__new__(Trees)
        vars(trees).update(tables)
        for pdf in parts:
            lo, chars = 0, pdf["text"].str.len().cumsum().to_numpy()
            while lo < len(pdf):
                hi = max(lo + 1, int(np.searchsorted(chars, (chars[lo - 1] if lo else 0) + 100_000)))
                part = pdf.iloc[lo:hi]
                lo = hi
                code, distinct = pd.factorize(part["text"])  # copies are read once
                runs = runs_of(distinct.tolist(), trees, neutral)
                rows_out = [(k, d, j, *r, len(runs[c])) for k, d, c in zip(part["key"], part["declared"], code, strict=True) for j, r in enumerate(runs[c])]
                yield pd.DataFrame(rows_out, columns=["key", "declared", "run_no", "lang", "first_word", "words", "confidence", "runs"])

    schema = f"key {kinds['key']}, declared string, run_no int, lang string, first_word int, words int, confidence double, runs int"
    return base.mapInPandas(find, schema).withColumnRenamed("key", key)
