"""Text normalisation as column expressions; all stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Body parts by the form used in labels.
BODY_PARTS = {"hand": "hands", "finger": "fingers", "nail": "nails", "fingernail": "fingernails", "left hand": "hands", "right hand": "hands", "human hand": "hands"}
#: Microphone words, and colour words that don't describe a sound.
MIC_WORDS = ["mic", "mics", "microphone", "microphones"]
COLOURS = ["red", "blue", "green", "pink", "purple", "black", "white", "yellow", "orange", "teal", "amber", "golden", "silver", "metallic", "glittery"]
#: Tool materials by keyword, first hit wins; "metal tool" otherwise.
TOOL_MATERIALS = [("wooden tool", ["bamboo", "wooden", "wood"]), ("metal tool", ["metal", "metallic", "spring", "steel"]), ("plastic tool", ["plastic"]), ("cotton tool", ["cotton", "fluffy", "swab"]), ("silicone tool", ["silicone", "rubber"])]
#: Names of ear picks; swabs; brushes by containment; the ear as a receiver and what tells that it is a model.
EAR_TOOLS = ["ear pick", "earpick", "ear picks", "earpicks", "ear stick", "ear cleaner", "ear cleaning"]
SWABS = ["cotton swab", "cotton tip"]
BRUSHES = ["paint brush", "makeup brush", "hairbrush"]
EARS = ["ear", "ears", "left ear", "right ear", "ear canal", "eardrum"]
EARPHONES = ["earpod", "earpods", "earphone", "earphones", "earbud", "earbuds", "earphone mic"]
EAR_MODEL = r"(?i)\b(silicone|binaural|3dio|mannequin|dummy head|ear model|ear replica|ear-shaped)\b"
EAR_FORMS = [("glass ear", ["crystal ear"]), ("wooden ear", ["wooden ear"]), ("silicone ear", ["dummy head", "wooden head"])]
#: Reasons of a failed run by needle, first hit wins; "unknown" otherwise.
FAILURES = [
    ("rate_limit", ["rate limit", "too many requests", "http 429", "status 429", "quota exceeded"]),
    ("timeout", ["timed out", "timeout", "deadline exceeded"]),
    ("network", ["connection reset", "connection refused", "connection aborted", "temporary failure in name resolution", "name or service not known", "network is unreachable", "remote end closed", "http 502", "http 503", "http 504"]),
    ("authentication", ["unauthorized", "forbidden", "http 401", "http 403", "sign in", "cookie"]),
    ("source_unavailable", ["video unavailable", "private video", "removed", "not available", "members-only", "age-restricted"]),
    ("source_too_long", ["video too long", "duration exceeds", "too long", "maximum duration"]),
    ("media_processing", ["ffmpeg", "ffprobe", "decode", "invalid data found", "unsupported codec"]),
    ("missing_input", ["no such file", "not found", "missing audio", "missing image", "不存在"]),
    ("storage", ["no space left", "disk quota", "read-only file system"]),
    ("invalid_input", ["invalid input", "invalid url", "parse error", "jsondecodeerror", "缺少有效"]),
    ("api_error", ["api error", "internal server error", "service unavailable", "bad gateway"]),
]


def let(x: Column, f) -> Column:
    """f(x) with x evaluated once, so that a long chain of rules doesn't repeat its input in the generated code."""
    return F.element_at(F.transform(F.array(x), lambda v: f(v)), 1)


def stripped(x: Column) -> Column:
    """Without outer white space of any kind."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def squeezed(x: Column) -> Column:
    """Trimmed, inner white space as one blank."""
    return F.regexp_replace(stripped(x), r"(?U)\s+", " ")


def none_if_empty(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def token(x: Column) -> Column:
    """Trimmed, lower case, white space as `_`; empty for null."""
    return F.coalesce(F.regexp_replace(stripped(F.lower(x)), r"(?U)\s+", "_"), F.lit(""))


def phrase(x: Column) -> Column:
    """Trimmed, lower case, squeezed; null for null and blank."""
    return none_if_empty(squeezed(F.lower(x)))


def audit_text(x: Column) -> Column:
    """As `phrase`, with `_` as a blank."""
    return phrase(F.translate(x, "_", " "))


def noun(x: Column) -> Column:
    """Audit text with body parts and microphone words in one form."""
    parts = F.create_map(*[F.lit(v) for kv in BODY_PARTS.items() for v in kv])
    rules = lambda t: F.when(F.contains(t, F.lit("3dio")), "3dio mic").when(t.isin(MIC_WORDS), "mic").otherwise(F.coalesce(F.try_element_at(parts, t), t))
    return let(audit_text(x), rules)


def slug(x: Column) -> Column:
    """Runs of other characters than letters and digits as `-`; `_` for null and empty."""
    t = F.regexp_replace(F.regexp_replace(F.lower(x), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")
    return F.coalesce(none_if_empty(t), F.lit("_"))


def group_id(prefix: str, *parts: Column) -> Column:
    return F.concat_ws("__", F.lit(prefix), *[slug(p) for p in parts])


def singular(word: Column) -> Column:
    """Naive singular: ies to y (of words longer than that), es and s dropped (not of ss); no word becomes empty."""
    cut = lambda n, end="": F.concat(F.substring(word, F.lit(1), F.length(word) - n), F.lit(end))
    longer = lambda end: word.endswith(end) & (F.length(word) > len(end))
    return F.when(longer("ies"), cut(3, "y")).when(longer("es"), cut(2)).when(longer("s") & ~word.endswith("ss"), cut(1)).otherwise(word)


def without_colours(x: Column) -> Column:
    return squeezed(F.regexp_replace(x, rf"(?i)\b({'|'.join(COLOURS)})\b", ""))


def _holds(x: Column, needles: list[str]) -> Column:
    out = F.lit(False)
    for n in needles:
        out = out | F.contains(x, F.lit(n))
    return out


def first_hit(x: Column, table: list[tuple[str, list[str]]], default: str) -> Column:
    """The name of the first row of `table` one of whose needles stands in `x`."""
    out = None
    for name, needles in table:
        out = F.when(_holds(x, needles), name) if out is None else out.when(_holds(x, needles), name)
    return out.otherwise(default)


def tool(x: Column) -> Column:
    """Tools of the ear-pick family by material; tweezers, spoolies, swabs and brushes in one form, wherever the word stands."""
    brush = x.endswith(" brush") | x.endswith(" brushes") | _holds(x, BRUSHES)
    return (
        F.when(_holds(x, EAR_TOOLS), first_hit(x, TOOL_MATERIALS, "metal tool"))
        .when(_holds(x, ["tweezer"]), "metal tool").when(_holds(x, ["spoolie"]), "plastic tool").when(_holds(x, SWABS), "cotton swab")
        .when(brush, F.when(_holds(x, ["wood"]), "wooden brush").otherwise("brush"))
        .when(_holds(x, ["fork"]) & _holds(x, ["brush"]), "brush")
        .otherwise(x)
    )


def receiver(x: Column, context: Column) -> Column:
    """The ear that a sound goes to, told from the words around (`context`): a model ear, else a microphone for earphones."""
    around = F.coalesce(context, F.lit(""))
    model = around.rlike(EAR_MODEL)
    hinted = model | _holds(F.lower(around), ["ear cleaning", "silicone"])
    forms = x
    for name, needles in reversed(EAR_FORMS):
        forms = F.when(_holds(x, needles), name).otherwise(forms)
    return (
        F.when(x.isin(EARS) & hinted, F.when(x == "ears", "silicone ears").otherwise("silicone ear"))
        .when(x.isin(EARPHONES), F.when(model, "silicone ear").otherwise("mic"))
        .otherwise(forms)
    )


def noun_phrase(x: Column, *context: Column) -> Column:
    """noun, colours dropped, tools, ears and wax in one form, noun again; `fail` stays. `context` are the texts around."""
    around = F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in context]) if context else F.lit("")
    t = F.regexp_replace(let(let(without_colours(noun(x)), tool), lambda t: receiver(t, around)), "sealing wax", "wax")
    recorder = lambda t: F.when(F.contains(t, F.lit("recorder")) & ~F.contains(t, F.lit("mic")), "mic").otherwise(none_if_empty(t))
    return F.when(is_fail(x), "fail").otherwise(let(noun(t), recorder))


def is_fail(x: Column) -> Column:
    """The sentinel for "could not be told"; false for null."""
    return F.coalesce(stripped(F.lower(x)) == "fail", F.lit(False))


def is_filled(x: Column) -> Column:
    return x.isNotNull() & ~is_fail(x) & (F.coalesce(stripped(x), F.lit("")) != "")


def caption(*parts: Column) -> Column:
    """The filled parts with blanks between; null if there is none."""
    return none_if_empty(F.concat_ws(" ", *[F.when(is_filled(p), stripped(p)) for p in parts]))


def confidence(x: Column) -> Column:
    """A whole number from 1 to 10, half to even; 1 for what is no number."""
    return F.greatest(F.lit(1), F.least(F.lit(10), F.coalesce(F.bround(x.try_cast("double")), F.lit(1.0)))).cast("int")


def detail(x: Column, limit: int = 500) -> Column:
    return F.substring(squeezed(F.coalesce(x, F.lit(""))), 1, limit)


def failure_reason(x: Column) -> Column:
    """By the whole text, also behind what `detail` keeps."""
    return let(F.lower(squeezed(F.coalesce(x, F.lit("")))), lambda t: first_hit(t, FAILURES, "unknown"))


def audio_id(path: Column) -> Column:
    """The path behind `splitted/` (else its base name) without suffix, parts joined by `__`, other signs as `_`."""
    behind = F.when(F.contains(path, F.lit("splitted/")), F.regexp_extract(path, r"^.*?splitted/(.*)$", 1)).otherwise(F.regexp_extract(path, r"([^/]*)$", 1))
    t = F.regexp_replace(F.regexp_replace(behind, r"\.[^./]*$", ""), "/", "__")
    return F.regexp_replace(F.regexp_replace(t, r"[^A-Za-z0-9._-]+", "_"), r"^_+|_+$", "")


def stem(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(.)\.[^.]*$", "$1")


def has_cjk(x: Column) -> Column:
    """Whether kana or Han signs occur."""
    return F.coalesce(x.rlike("[\\u3040-\\u309F\\u30A0-\\u30FF\\u4E00-\\u9FFF]"), F.lit(False))


def is_blocked(label: Column) -> Column:
    """Labels of previews, intros, combinations and mixes (not of mixing); one product name is allowed."""
    x = F.coalesce(F.lower(label), F.lit(""))
    return ~F.contains(x, F.lit("mixed beeswax soup")) & (_holds(x, ["preview", "intro", "combination"]) | (F.contains(x, F.lit("mix")) & ~F.contains(x, F.lit("mixing"))))


def is_parallel(label: Column) -> Column:
    return _holds(F.coalesce(label, F.lit("")), ["+", "&"])


#: States of an annotation that does not count as finished.
NOT_FINISHED = ["pending", "skip", "skipped", "invalid", "excluded"]


def is_completed(status: Column, subject: Column, verb: Column) -> Column:
    """Whether an annotation counts: a state other than those in NOT_FINISHED (none will do), a subject and a verb."""
    return ~F.coalesce(audit_text(status), F.lit("")).isin(NOT_FINISHED) & audit_text(subject).isNotNull() & audit_text(verb).isNotNull()


#: Nouns that name a material though no alias does, and nouns that never do.
MATERIAL_CORES = {"ice": "glass", "styrofoam": "foam_solid", "silicone": "rubber", "chalk": "ceramic", "marble": "stone", "granite": "stone", "beeswax": "wax", "cardboard": "paper"}
NO_LEAK = ["sponge", "wooden surface"]


def leaked_material(core: Column, aliases: dict[str, str], cores: dict[str, str] | None = None, allowed: list[str] | None = None) -> Column:
    """struct(reason, material) that a noun gives away, null if nothing: none of `allowed`; the word "material" itself
    (without a material); an alias as a whole; a noun of `cores`; an alias of several words inside, the longest first; one
    of its words or its singular as an alias or a noun of `cores`, the first hit in reading order."""
    cores, allowed = MATERIAL_CORES if cores is None else cores, NO_LEAK if allowed is None else allowed
    lookup = lambda d: F.create_map(*[F.lit(v) for kv in d.items() for v in kv]) if d else F.create_map().cast("map<string,string>")
    hit = lambda reason, of, m: F.struct(F.concat(F.lit(f"{reason}:"), of).alias("reason"), m.alias("material"))
    by_alias, by_core = lookup(aliases), lookup(cores)

    def told(text: Column) -> Column:
        words = F.split(text, " ")
        form = lambda w: F.coalesce(
            F.when(F.try_element_at(by_alias, w).isNotNull(), hit("token_alias", w, F.try_element_at(by_alias, w))),
            F.when(F.try_element_at(by_core, w).isNotNull(), hit("extra_token", w, F.try_element_at(by_core, w))),
        )
        inner = [F.when(F.contains(text, F.lit(k)), hit("subphrase_alias", F.lit(k), F.lit(aliases[k]))) for k in sorted(aliases, key=lambda k: -len(k)) if " " in k]
        each = F.filter(F.flatten(F.transform(words, lambda w: F.array(form(w), form(singular(w))))), lambda f: f.isNotNull())
        return F.when(text.isin(allowed), F.lit(None)).otherwise(F.coalesce(
            F.when(F.array_contains(words, "material"), F.struct(F.lit("contains_word_material").alias("reason"), F.lit(None).cast("string").alias("material"))),
            F.when(F.try_element_at(by_alias, text).isNotNull(), hit("exact_alias", text, F.try_element_at(by_alias, text))),
            F.when(F.try_element_at(by_core, text).isNotNull(), hit("extra_core", text, F.try_element_at(by_core, text))),
            *inner, F.get(each, 0),
        ))

    return let(phrase(core), told)
