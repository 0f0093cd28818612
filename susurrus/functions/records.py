"""Keys, names, paths and texts of annotation records as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import audit_text, is_fail, none_if_empty, noun, stripped, token


def segment_label(seg: Column, label: Column) -> Column:
    """The segment's label, else the event's, trimmed; empty if there is none."""
    return stripped(F.coalesce(none_if_empty(seg), label, F.lit("")))


def event_key(video: Column, start: Column, end: Column) -> Column:
    """`id_start_end` with whole seconds (cut, not rounded)."""
    return F.concat_ws("_", F.coalesce(video, F.lit("")), *[F.coalesce(x.cast("double").cast("bigint"), F.lit(0)).cast("string") for x in (start, end)])


def svo_field(x: Column, as_noun: bool) -> Column:
    """A field of an answer: null for blank and "null", `fail` for the sentinel, else the noun or token."""
    t = stripped(x)
    return F.when((t == "") | (F.lower(t) == "null"), F.lit(None)).when(is_fail(x), "fail").otherwise(noun(x) if as_noun else none_if_empty(token(x)))


def json_object(content: Column, schema: str) -> Column:
    """A reply as a struct of `schema`, code fences around it dropped; null for what is no JSON object."""
    t = stripped(content)
    bare = F.when(t.startswith("```"), F.regexp_replace(F.regexp_replace(t, r"^```[a-zA-Z0-9_-]*\s*", ""), r"\s*```\s*$", "")).otherwise(t)
    whole = F.from_json(bare, f"{schema}, __bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"})
    return F.when(bare.startswith("{") & whole["__bad"].isNull(), whole.dropFields("__bad"))


def filled(template: Column, values: dict[str, Column]) -> Column:
    """The template with each `{KEY}` replaced, in the given order; null values as the empty string."""
    for key, value in values.items():
        template = F.replace(template, F.lit("{" + key + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return template


def manifest_id(audio: Column, wav: Column) -> Column:
    """The audio id, else the stem of the path; an error where both are blank."""
    stem = F.regexp_replace(F.regexp_extract(stripped(wav), r"([^/]*)$", 1), r"(.)\.[^.]*$", "$1")
    return F.coalesce(none_if_empty(stripped(audio)), none_if_empty(stem), F.raise_error(F.lit("a label has neither audio id nor wav")).cast("string"))


def relative_path(path: Column, prefix: str, root: str | None = None) -> Column:
    """The path below `root`, else behind `splitted/`, else its base name, under `prefix`."""
    behind = F.when(F.contains(path, F.lit("splitted/")), F.regexp_extract(path, r"^(?:.*?/)?splitted/(.*)$", 1)).otherwise(F.regexp_extract(path, r"([^/]*)$", 1))
    if root:
        top = root.rstrip("/") + "/"
        behind = F.when(path.startswith(top), F.substring(path, F.lit(len(top) + 1), F.length(path))).otherwise(behind)
    return F.concat(F.lit(prefix.rstrip("/") + "/"), behind)


def base_path(path: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix.rstrip("/") + "/"), F.regexp_extract(path, r"([^/]*)$", 1))


def video_of_url(url: Column) -> Column:
    """The `v` parameter of a watch address; null if there is none."""
    return none_if_empty(F.trim(F.regexp_extract(url, r"[?&]v=([^&]+)", 1)))


def video_of_ledger(url: Column, audio: Column) -> Column:
    """The video of a ledger row: from its address, else from the folder below `audio/`; empty if neither tells."""
    folder = none_if_empty(F.trim(F.regexp_extract(F.translate(audio, "\\", "/"), r"(?:^|/)audio/([^/]+)/", 1)))
    return F.coalesce(video_of_url(url), folder, F.lit(""))


def file_number(x: Column) -> Column:
    """A number for a file name: whole within 1e-6 without a point, else with `p` for the point."""
    whole = x.cast("double").cast("bigint")
    text = F.regexp_replace(F.format_string("%.9f", x.cast("double")), r"0+$", "")
    return F.when(F.abs(x - whole) < 1e-6, whole.cast("string")).otherwise(F.translate(text, ".", "p"))


def folder_name(video: Column, start: Column, end: Column) -> Column:
    return F.concat_ws("_", video, file_number(start), file_number(end))


def picture_name(video: Column, start: Column, end: Column) -> Column:
    """`video_start_end.png`; null where the name would hold a sign that file systems refuse."""
    name = F.concat(folder_name(video, start, end), F.lit(".png"))
    return F.when(~name.rlike(r'[<>:"/\\|?*]'), name)


def model_slug(model: Column, most: int = 24) -> Column:
    """The name behind the last slash in lower case without `-` and `.`, cut; "model" if nothing is left."""
    t = F.regexp_replace(F.lower(F.element_at(F.split(model, "/"), -1)), r"[-.]", "")
    return F.coalesce(none_if_empty(F.substring(t, 1, most)), F.lit("model"))


def first_struct(*nested: Column, row: Column) -> Column:
    """The first nested struct that is there, whole, else the row's own: fields are never mixed between them."""
    return F.coalesce(*nested, row)


def title_has(title: Column, keywords: list[str]) -> Column:
    """Whether any keyword (in lower case) stands in the title; false for null."""
    t, out = F.lower(F.coalesce(title, F.lit(""))), F.lit(False)
    for k in keywords:
        out = out | F.contains(t, F.lit(k))
    return out


def keywords(text: str) -> list[str]:
    """Keywords of a comma-separated argument, trimmed, in lower case, without blanks and repetitions."""
    return list(dict.fromkeys(k for k in (p.strip().lower() for p in text.split(",")) if k))


def watch_url(video: Column, known: Column, base: str = "https://www.youtube.com/watch?v=") -> Column:
    """The known address if it is one (http), else the one made from the id."""
    return F.coalesce(F.when(known.startswith("http"), known), F.concat(F.lit(base), video))


def _trimmed(x: Column) -> Column:
    return F.regexp_replace(F.format_string("%.6f", x), r"\.?0+$", "")


def section_stamp(seconds: Column) -> Column:
    """`H:MM:S.f`, `M:S.f` or `S.f`, up to six places, negative times as 0."""
    s = F.greatest(F.lit(0.0), seconds.cast("double"))
    h = F.floor(s / 3600)
    m = F.floor((s - h * 3600) / 60)
    return (
        F.when(s >= 3600, F.concat(F.format_string("%d:%02d:", h, m), _trimmed(s - h * 3600 - m * 60)))
        .when(s >= 60, F.concat(F.format_string("%d:", F.floor(s / 60)), _trimmed(s - F.floor(s / 60) * 60)))
        .otherwise(_trimmed(s))
    )


def section(start: Column, end: Column, least: float = 0.05) -> Column:
    """`*from-to` of a stretch, at least `least` seconds long; null where it doesn't end after its start."""
    till = F.greatest(end.cast("double"), start.cast("double") + least)
    return F.when(end > start, F.concat(F.lit("*"), section_stamp(start), F.lit("-"), section_stamp(till)))


def hashed_point(seed: Column, lo: Column, hi: Column) -> Column:
    """A point of the window, uniform by md5 of the seed: the same for the same row on every run."""
    share = F.conv(F.substring(F.md5(seed.cast("string")), 1, 8), 16, 10).cast("double") / float(1 << 32)
    return lo + F.greatest(F.lit(0.0), hi - lo) * share


def preferred_id(candidates: Column) -> Column:
    """The strongest identifier of a record; an error if it has none."""
    return F.coalesce(F.get(candidates, 0), F.raise_error(F.lit("a record has no identifier")).cast("string"))


def pair_key(left: Column, right: Column) -> Column:
    """The key of a pair of nouns in a cache: both normalised, null kept apart from text."""
    return F.to_json(F.array(F.coalesce(audit_text(left), F.lit("\0")), F.coalesce(audit_text(right), F.lit("\0"))))


def window_of_key(key: Column) -> Column:
    """struct(start, end) of a `start_end` window key; null where it isn't two numbers, the second greater."""
    a, b = F.substring_index(key, "_", 1).try_cast("double"), F.regexp_extract(key, r"^[^_]*_(.*)$", 1).try_cast("double")
    return F.when(b > a, F.struct(a.alias("start"), b.alias("end")))


def listed_url(video: Column, url: Column, base: str = "https://www.youtube.com/watch?v=") -> Column:
    """The address of a listed video: its own if it is one, else from its id, else from what stands in place of an address;
    null if nothing does."""
    u, v = F.trim(F.coalesce(url, F.lit(""))), F.trim(F.coalesce(video, F.lit("")))
    return F.when(u.rlike("^https?://"), u).when(v != "", F.concat(F.lit(base), v)).when(u != "", F.concat(F.lit(base), u))


def first_named(*names: Column) -> Column:
    """The first that isn't null or blank."""
    return F.coalesce(*[none_if_empty(stripped(n)) for n in names])


#: Formats of sound that a judge takes.
SOUND_FORMATS = ["wav", "mp3", "flac", "m4a", "ogg"]


def encoded_sound(path: Column, content: Column) -> Column:
    """struct(data in base64, format) of a file; another format than SOUND_FORMATS is an error."""
    kind = F.lower(F.regexp_extract(path, r"\.([^./]*)$", 1))
    good = F.when(kind.isin(SOUND_FORMATS), kind).otherwise(F.raise_error(F.concat(F.lit("unsupported sound: "), path)).cast("string"))
    return F.struct(F.base64(content).alias("data"), good.alias("format"))
