"""Several values packed in one field: infer the delimiters of a source, split outside quotes, explode with position."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import let

#: Candidate delimiters. The blank is judged apart, because it also stands beside the others and inside phrases.
STRONG = [";", "；", ",", "、", "，", "|", "/", "\t", "\n"]
BLANK = " "
#: Types of a piece: numbers or times, also several (signs between numbers are never part of a value, as decimal commas
#: are quoted); a phrase of up to four words, whose words may hold signs between letters ("on/off switch", "n/a"); and a
#: quoted piece. Anything else, such as a phrase with another separator in it, is irregular.
NUMBER = r"^[+-]?(?:\d+:)*\d+(?:\.\d+)?$"
_WORD = r"[\p{L}\p{N}_'’-]+(?:[/&.+][\p{L}\p{N}_'’-]+)*"
PHRASE = rf"^{_WORD}(?: {_WORD}){{0,3}}$"
HELD = "\u0001"
NUMBERS = rf"^(?:{NUMBER[1:-1]}|{HELD})(?:[\s;；,、，|/]+(?:{NUMBER[1:-1]}|{HELD}))*[\s;；,、，|/]*$"


def _cls(chars: list[str]) -> str:
    return "".join(re.escape(c) if c not in "\t\n" else {"\t": r"\t", "\n": r"\n"}[c] for c in chars)


def _core(cell):
    """The cell without outer blanks and without one pair of brackets around everything."""
    x = F.regexp_replace(cell, r"(?U)^\s+|\s+$", "")
    return F.regexp_replace(x, r"(?s)^(?:\[([^\[\]]*)\]|\(([^()]*)\)|\{([^{}]*)\})$", "$1$2$3")


def _masked(cell):
    """The cell with every quoted piece replaced by one sign, so that separators inside quotes don't count."""
    opens = rf"(?<![^{_cls(STRONG)}\s\[({{])"
    x = F.regexp_replace(_core(cell), rf'{opens}"[^"]*+(?:""[^"]*+)*+"', HELD)
    return F.regexp_replace(x, rf"{opens}'[^']*+(?:''[^']*+)*+'", HELD)


def delimiter_scores(df: DataFrame, source: str, cell: str) -> DataFrame:
    """Rows (source, delimiter, cells, pieces, deviation, regular, numeric, consistent, score): every candidate scored alone.

    For the cells that hold the candidate outside quotes, split at it and at nothing else: the mean and the deviation of
    the number of non-empty pieces, the share of the cells all of whose pieces are of a regular type, and the share of
    numbers and times among the pieces. The blank is scored on the cells that no strong candidate stands in. `consistent`
    = 1 / (1 + deviation / pieces) falls with the spread of the piece counts, and is 0 where the candidate cuts no cell in
    two; score = regular * consistent. Cells without a piece are left out.

    One aggregation with a map-side combine; its result has at most one row a source and candidate.
    """
    masked = df.select(F.col(source).alias("source"), _masked(F.col(cell)).alias("m"))
    held = F.array_compact(F.array(
        *[F.when(F.contains(F.col("m"), F.lit(d)), F.lit(d)) for d in STRONG], F.when(~F.col("m").rlike(f"[{_cls(STRONG)}]") & F.contains(F.col("m"), F.lit(BLANK)), F.lit(BLANK))
    ))
    number = lambda p: p.rlike(NUMBER) | (p == HELD)
    own = F.filter(F.transform(F.split("m", F.concat(F.lit("\\Q"), "delimiter", F.lit("\\E"))), lambda p: F.regexp_replace(p, r"(?U)^\s+|\s+$", "")), lambda p: p != "")
    kinds = let(own, lambda ps: F.struct(F.size(ps).alias("n"), F.forall(ps, lambda p: p.rlike(NUMBERS) | p.rlike(PHRASE)).cast("int").alias("regular"), F.size(F.filter(ps, number)).alias("numeric")))
    sums = (
        masked.select("source", "m", F.explode(held).alias("delimiter")).select("source", "delimiter", kinds.alias("k")).select("source", "delimiter", "k.*").where("n > 0")
        .groupBy("source", "delimiter")
        .agg(F.count("*").alias("cells"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.max("n").alias("most"), F.avg("regular").alias("regular"), F.avg(F.col("numeric") / F.col("n")).alias("numeric"))
    )
    mean = F.col("n") / F.col("cells")
    deviation = F.sqrt(F.greatest(F.lit(0.0), F.col("nn") / F.col("cells") - mean * mean))
    x = sums.select("source", "delimiter", "cells", mean.alias("pieces"), deviation.alias("deviation"), "regular", "numeric", "most")
    x = x.withColumn("consistent", F.when(F.col("most") < 2, F.lit(0.0)).otherwise(1 / (1 + F.col("deviation") / F.col("pieces")))).drop("most")
    return x.withColumn("score", F.col("regular") * F.col("consistent"))


def infer_delimiters(df: DataFrame, source: str, cell: str, least_regular: float = 0.4, least_of_best: float = 0.3) -> dict[str, list[str]]:
    """The delimiters of each source (the number of sources is small: one a table and field).

    Cells of one source may be separated in several ways, so every strong candidate is taken whose own pieces are
    regular (`least_regular`) and whose score reaches the share `least_of_best` of the best candidate's; a sign that stands
    inside values leaves pieces with the true separator in them and fails. The blank is taken where it alone stands
    between numbers or times, or between words if the source has no strong delimiter.
    """
    found: dict[str, list[str]] = {}
    blanks: dict[str, tuple[float, float]] = {}
    strong: dict[str, list[tuple[str, float, float]]] = {}
    for x in delimiter_scores(df, source, cell).collect():
        if x["delimiter"] == BLANK:
            blanks[x["source"]] = (x["regular"], x["numeric"])
        else:
            strong.setdefault(x["source"], []).append((x["delimiter"], x["regular"], x["score"]))
    for at, scored in strong.items():
        best = max(s for _, _, s in scored)
        if taken := [d for d, regular, s in scored if regular >= least_regular and s > 0 and s >= least_of_best * best]:
            found[at] = taken
    for at, (regular, numeric) in blanks.items():
        if numeric >= 0.8 or (regular >= 0.8 and at not in found):
            found.setdefault(at, []).append(BLANK)
    return {k: sorted(v) for k, v in found.items()}


def _unquoted(p):
    p = F.regexp_replace(p, r"(?U)^\s+|\s+$", "")
    p = (
        F.when(p.rlike(r'(?s)^".*"$') & (F.length(p) > 1), F.replace(F.substring(p, F.lit(2), F.length(p) - 2), F.lit('""'), F.lit('"')))
        .when(p.rlike(r"(?s)^'.*'$") & (F.length(p) > 1), F.replace(F.substring(p, F.lit(2), F.length(p) - 2), F.lit("''"), F.lit("'")))
        .otherwise(F.regexp_replace(p, r"^(?:\[([^\[\]]*)\]|\(([^()]*)\)|\{([^{}]*)\})$", "$1$2$3"))
    )
    return F.regexp_replace(p, r"(?U)^\s+|\s+$", "")


def split_cell(cell, delimiters: list[str]):
    """Array of the non-empty values of a cell, in order, without quotes, brackets and outer blanks."""
    c = _cls(delimiters)
    if not c:
        return F.filter(F.array(_unquoted(_core(cell))), lambda p: p != "")
    ends = rf"(?=\s*(?:[{c}]|$))"
    pattern = rf"""\s*("[^"]*+(?:""[^"]*+)*+"{ends}|'[^']*+(?:''[^']*+)*+'{ends}|[^{c}]*)\s*(?:[{c}]|$)"""
    return F.filter(F.transform(F.regexp_extract_all(_core(cell), F.lit(pattern), F.lit(1)), _unquoted), lambda p: p != "")


def unpack(df: DataFrame, source: str, cell: str, keep: list[str], least_values: int = 2, delimiters: dict[str, list[str]] | None = None) -> DataFrame:
    """Rows (keep, pos, val): one a value of every cell with at least `least_values` values, `pos` from 0.

    Separators inside quotes don't separate; a doubled quote inside quotes is one quote; an unclosed quote is text. Null,
    empty and blank cells and cells of separators only give no row. Repeated rows give repeated values. A source without
    an accepted delimiter has one value a cell. The width of a row's array is the number of values in its own cell.
    """
    by = infer_delimiters(df, source, cell) if delimiters is None else delimiters
    # sources with the same delimiters share a branch, so the plan grows with the sets of delimiters, not with the sources
    sets: dict[tuple[str, ...], list[str]] = {}
    for at, ds in by.items():
        sets.setdefault(tuple(ds), []).append(at)
    vals = split_cell(F.col(cell), [])
    for ds, at in sets.items():
        vals = F.when(F.col(source).isin(at), split_cell(F.col(cell), list(ds))).otherwise(vals)
    # a filter above the projection would be pushed below it and split every cell twice
    enough = let(vals, lambda v: F.when(F.size(v) >= least_values, v))
    return df.select(*keep, F.posexplode(enough).alias("pos", "val"))
