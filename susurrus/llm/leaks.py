"""Evaluation texts leaking into training text."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import cut
from .words import words

#: Up to this many windows, or tokens, are broadcast; beyond it the joins shuffle. A window costs about 200 bytes.
BROADCAST_WINDOWS = 200_000


def windows(items: DataFrame, item: str, text: str, width: int) -> DataFrame:
    """Rows (item, at, win): every run of `width` words of every item."""
    w = items.select(F.col(item).alias("item"), words(F.col(text)).alias("w")).where(F.size("w") >= width)
    return w.select("item", F.explode(F.sequence(F.lit(0), F.size("w") - width)).alias("at"), "w").select("item", "at", F.slice("w", F.col("at") + 1, width).alias("win"))


def leaked(docs: DataFrame, doc: str, text: str, items: DataFrame, item: str, item_text: str, width: int = 8, salts: int = 16) -> DataFrame:
    """Rows (doc, item, first_word, words): documents that hold `width` or more consecutive words of an item, with the
    place of the first and the number of leaked words (those inside any shared window).

    A prefix-filtered set join. The tokens of a window are ordered by their frequency over the whole corpus. As a match
    must hold the whole window, one token suffices as its prefix: the rarest. Only places in documents where such a token
    stands are joined with the windows that it leads; the length and positional bounds (the window must begin and end
    inside the document at the offset of the token) and then the comparison of the whole window against the words at
    that place decide exactly. All documents are read whole; no candidate is dropped.

    Texts are cut into words once; the words are written to the shared folder and read twice, for the frequencies and for
    the windows. A place carries the words within reach of a window only, never the document. Up to BROADCAST_WINDOWS
    windows are broadcast. Beyond it places are filtered by their token, still by broadcast up to BROADCAST_WINDOWS leading
    tokens, and shuffled over `salts` parts of each token, the windows repeated for every part, so a token that leads many
    windows and stands in many places is spread.

    Words are runs of letters and digits; case, punctuation, line breaks, character width and invisible characters don't
    matter. Null and short texts leak nothing; items below `width` words have no window; a null id of either side is
    kept as an id; repeated documents each give their rows; columns other than those named are not read.
    """
    win = cut(windows(items, item, item_text, width))
    small = win.count() <= BROADCAST_WINDOWS
    vocab = cut(win.select(F.explode("win").alias("tok")).distinct())
    few = vocab.count() <= BROADCAST_WINDOWS
    hint = F.broadcast if few else (lambda x: x)
    # no filter by length here: it would be pushed below the projection and cut every text twice
    tokens = cut(docs.select(F.col(doc).alias("doc"), words(F.col(text)).alias("w")))
    counts = tokens.select(F.explode("w").alias("tok")).join(hint(vocab), "tok").groupBy("tok").agg(F.count("*").alias("n"))
    lead = Window.partitionBy("item", "at").orderBy(F.coalesce("n", F.lit(0)), "tok")
    led = (
        win.select("item", "at", "win", F.posexplode("win").alias("off", "tok")).join(hint(counts), "tok", "left")
        .withColumn("k", F.row_number().over(lead)).where("k = 1").select("tok", "item", "off", "at", "win")
    )
    # equal windows of several items are compared once
    same = cut(led.groupBy("tok", "off", "win").agg(F.collect_set("item").alias("items")))
    placed = tokens.where(F.size("w") >= width).select("doc", "w", F.posexplode("w").alias("pos", "tok"))
    near = F.slice("w", F.greatest(F.col("pos") - (width - 1), F.lit(0)) + 1, 2 * width - 1)
    if small:
        at = placed.join(F.broadcast(same), "tok").select("doc", "pos", "off", "win", "items", near.alias("w"))
    else:
        leads = cut(same.select("tok").distinct())
        if leads.count() <= BROADCAST_WINDOWS:
            placed = placed.join(F.broadcast(leads), "tok", "left_semi")
        places = placed.select("doc", "pos", "tok", near.alias("w"), F.pmod(F.xxhash64("doc", "pos"), F.lit(salts)).alias("salt"))
        spread = same.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).withColumn("salt", F.col("salt").cast("long"))
        at = places.join(spread, ["tok", "salt"]).select("doc", "pos", "off", "win", "items", "w")
    # the words `w` begin at this place of the document; the window at this place of `w`
    first = F.greatest(F.col("pos") - (width - 1), F.lit(0))
    start = F.col("pos") - F.col("off")
    within = F.when((start >= 0) & (start - first + width <= F.size("w")), F.slice("w", F.greatest(start - first, F.lit(0)) + 1, width))
    hits = at.where(within == F.col("win")).select("doc", F.explode("items").alias("item"), start.alias("start"))
    covered = F.size(F.array_distinct(F.flatten(F.transform(F.collect_set("start"), lambda s: F.sequence(s, s + width - 1)))))
    return hits.groupBy("doc", "item").agg(F.min("start").alias("first_word"), covered.alias("words")).select(F.col("doc").alias(doc), F.col("item").alias(item), "first_word", "words")
