"""Ordered rules over the columns of a row: tables of conditions, the first that holds gives the value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import caption, is_fail, is_filled, none_if_empty, noun_phrase, stripped, token

#: What tells that a sound is made in a liquid. Some alternatives end within a word on purpose, so that longer
#: words ("fizzing") don't count.
LIQUID = r"(?i)\b(water|liquid|soapy|submerged|effervesc|bath bomb|fluid|fizz|bubbles?\b|contains liquid|agitated by airflow)\b"
#: Verbs of cleaning an ear or microphone by what is used (first hit wins), and what must be around.
CLEANED = ["ear", "mic", "silicone"]
CLEANING = [("brushing", ["brush", "spoolie", "bristle", "makeup", "fluffy ball"], []), ("wiping", ["cotton", "swab", "pad", "wipe", "cloth", "konjac", "sponge"], []), ("rubbing", ["finger", "nail", "hand"], ["pick", "stick"])]
#: Signs of bubbles, of foam as well, and of leaves.
BUBBLES, LEAVES = ["fizz", "bubble", "dissolv", "effervesc"], ["leaf", "leaves", "rustl"]
#: What a blown liquid is, by what is seen (first hit wins); water otherwise.
BLOWN = [("soapy water", ["soap"]), ("water", ["bath bomb"]), ("plastic spheres", ["sphere", "orb"])]


def holds(x: Column, needles: list[str]) -> Column:
    """Whether any of the needles stands in the text; false for null."""
    t, out = F.coalesce(x, F.lit("")), F.lit(False)
    for n in needles:
        out = out | F.contains(t, F.lit(n))
    return out


def first_of(*rules: tuple[Column, Column | str | None]) -> Column:
    """The value of the first rule whose condition is true; null if there is none."""
    out = None
    for condition, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out


def around(*texts: Column) -> Column:
    """Texts of a row in lower case, with blanks between."""
    return F.lower(F.concat_ws(" ", *[F.coalesce(t, F.lit("")) for t in texts]))


def in_liquid(*texts: Column) -> Column:
    return F.concat_ws(" ", *[F.coalesce(t, F.lit("")) for t in texts]).rlike(LIQUID)


def cleaning_verb(subject: Column, obj: Column, label: Column, seen: Column) -> Column:
    """brushing, wiping, rubbing or scraping by the tool; null where nothing around is cleaned."""
    tool = F.lower(F.coalesce(subject, F.lit("")))
    rules = [(holds(tool, yes) & ~holds(tool, no), verb) for verb, yes, no in CLEANING]
    return F.when(holds(F.concat(*[F.lower(F.coalesce(x, F.lit(""))) for x in (obj, seen, label, subject)]), CLEANED), first_of(*rules, (F.lit(True), "scraping")))


def melting_verb(label: Column, seen: Column) -> Column:
    """pressing or bubbling for bath bombs, bubbling where bubbles are seen, else crushing."""
    sl, vis = F.lower(label), F.lower(seen)
    bomb = holds(sl, ["bath bomb"]) | holds(vis, ["bath bomb"])
    return first_of((bomb & holds(vis, LEAVES), "pressing"), (bomb & holds(vis, [*BUBBLES, "foam"]), "bubbling"), (holds(vis, BUBBLES), "bubbling"), (F.lit(True), "crushing"))


def resolved_verb(raw: Column, subject: Column, obj: Column, label: Column, seen: Column, lexicon: list[str], aliases: dict[str, str]) -> Column:
    """struct(verb, source): missing; the rules for cleaning and melting (of the raw verb as written), if they give a verb of
    the lexicon; the lexicon; an alias into it; unmapped. Lexicon and aliases are closed vocabularies."""
    key = token(raw)
    known = F.array(*[F.lit(v) for v in sorted(lexicon)]) if lexicon else F.array().cast("array<string>")
    into = {a: t for a, t in aliases.items() if t in set(lexicon)}
    alias = F.try_element_at(F.create_map(*[F.lit(x) for kv in sorted(into.items()) for x in kv]), key) if into else F.lit(None).cast("string")
    out = lambda verb, source: F.struct(verb.alias("verb"), F.lit(source).alias("source"))
    cleaned, melted = cleaning_verb(subject, obj, label, seen), melting_verb(label, seen)
    return first_of(
        (F.coalesce(raw, F.lit("")).eqNullSafe("") | is_fail(raw), out(F.lit(None).cast("string"), "missing")),
        ((raw == "cleaning") & F.array_contains(known, F.coalesce(cleaned, F.lit(""))), out(cleaned, "rule_cleaning")),
        ((raw == "melting") & F.array_contains(known, melted), out(melted, "rule_melting")),
        (F.array_contains(known, key), out(key, "lexicon")), (alias.isNotNull(), out(alias, "alias")), (F.lit(True), out(F.lit(None).cast("string"), "unmapped")),
    )


def blown_liquid(verb: Column, subject: Column, obj: Column, label: Column, seen: Column, title: Column) -> Column:
    """struct(verb, subject, object, note): air blown into a liquid is air that bubbles it; other rows stay."""
    what = first_of(*[(holds(around(label, seen), needles), name) for name, needles in BLOWN], (F.lit(True), "water"))
    same = F.struct(verb.alias("verb"), subject.alias("subject"), obj.alias("object"), F.lit(None).cast("string").alias("note"))
    return F.when((verb == "blowing") & in_liquid(label, seen, title), F.struct(F.lit("bubbling").alias("verb"), F.lit("air").alias("subject"), what.alias("object"), F.lit("blow_liquid_to_bubbling").alias("note"))).otherwise(same)


def apart(subject: Column, verb: Column, obj: Column, label: Column, seen: Column) -> Column:
    """struct(subject, object, note): a subject that equals its object is told apart by six rules; other rows stay."""
    sl, vis = F.lower(label), F.lower(seen)
    out = lambda s, o, note: F.struct(F.lit(s).alias("subject"), F.lit(o).alias("object"), F.lit(note).cast("string").alias("note"))
    same = is_filled(subject) & is_filled(obj) & (subject == obj)
    nails = subject.isin("nails", "fingernails") & holds(sl, ["click"])
    soap = (subject == "soap") & verb.isin("crushing", "cutting", "carving", "slicing")
    rules = first_of(
        ((subject == "hair") & (verb == "brushing"), out("brush", "hair", "hair_brush_subject")),
        (nails & holds(vis, ["mic"]), out("nails", "mic", "clicking_mic")), (nails, out("nails", "hard surface", "clicking_surface")),
        (soap & holds(vis, ["hand"]), out("hands", "soap", "crushing_soap")), (soap, out("metal tool", "soap", "carving_soap")),
        ((subject == "mic") & (verb == "rubbing"), out("hands", "mic", "mic_rubbing_hands")), (holds(sl, ["modeling pack"]), out("modeling pack", "silicone ear", "modeling_pack_subject")),
    )
    return F.coalesce(F.when(same, rules), F.struct(subject.alias("subject"), obj.alias("object"), F.lit(None).cast("string").alias("note")))


def seen_verb(raw: Column, label: Column, seen: Column) -> Column:
    """The verb that label and picture suggest where none could be told; null otherwise."""
    sl, vis = F.lower(label), F.lower(seen)
    rules = first_of(
        (holds(sl, ["kissing"]) | holds(vis, ["kiss"]), "licking"), (holds(sl, ["popping candy"]) | holds(vis, ["popping candy"]), "popping"),
        (holds(vis, ["crunch", "stretch"]) & holds(sl, ["slime"]), "crunching"), (holds(vis, ["rub", "press", "tap"]), "rubbing"),
    )
    return F.when(is_fail(raw), rules)


def prop(subject: Column) -> Column:
    """Toy figures as what they are made of."""
    return F.when(is_filled(subject) & holds(F.lower(subject), ["unicorn"]), "plastic toy").otherwise(subject)


def normalized(df, raw: str, subject: str, obj: str, label: str, seen: str, title: str, lexicon: list[str], aliases: dict[str, str]):
    """Adds verb, subject, object, verb_source, note, caption, review and reasons: nouns by `noun_phrase`, the verb by
    `resolved_verb` (else by what is seen), blown liquids, equal subject and object told apart, what is left for review.
    Stages are columns of their own, so no rule is evaluated more than once a row."""
    c = F.col
    x = df.withColumn("__s", prop(noun_phrase(c(subject), c(label), c(title)))).withColumn("__o", noun_phrase(c(obj), c(label), c(title)))
    x = x.withColumn("__v", resolved_verb(c(raw), c("__s"), c(obj), c(label), c(seen), lexicon, aliases))
    fallback = seen_verb(c(raw), c(label), c(seen))
    x = x.withColumn("__verb", F.coalesce("__v.verb", fallback)).withColumn("__source", F.when(c("__v.verb").isNull() & fallback.isNotNull(), "rule_visual").otherwise(c("__v.source")))
    x = x.withColumn("__b", blown_liquid(c("__verb"), c("__s"), c("__o"), c(label), c(seen), c(title)))
    x = x.withColumn("__a", apart(c("__b.subject"), c("__b.verb"), c("__b.object"), c(label), c(seen)))
    reasons = F.array_compact(F.array(F.when(is_fail(c("__a.subject")), "subject_fail"), F.when(c("__b.verb").isNull(), "verb_fail"), F.when(is_fail(c("__a.object")), "object_fail")))
    return x.select(
        *df.columns, c("__b.verb").alias("norm_verb"), c("__a.subject").alias("norm_subject"), c("__a.object").alias("norm_object"), c("__source").alias("verb_source"), none_if_empty(F.concat_ws(";", "__b.note", "__a.note")).alias("note"),
        caption(c("__a.subject"), c("__b.verb"), c("__a.object")).alias("norm_caption"), F.array_join(reasons, ";").alias("review"),
    )


def shortlist(classes: Column, known: list[str], most: int = 2) -> Column:
    """The first two distinct known classes of a list, compared as tokens; a single one counts twice."""
    names = F.create_map(*[F.lit(x) for k in known for x in (k.strip().lower().replace(" ", "_"), k)]) if known else F.create_map().cast("map<string,string>")
    found = F.slice(F.array_distinct(F.array_compact(F.transform(classes, lambda v: F.try_element_at(names, token(v))))), 1, most)
    return F.when(F.size(found) == 1, F.array_repeat(F.get(found, 0), most)).otherwise(found)


def event_class(own: Column, listed: Column) -> Column:
    """The class of an event, else the first of its shortlist; empty if neither is there."""
    return F.coalesce(none_if_empty(stripped(own)), none_if_empty(stripped(F.get(listed, 0))), F.lit(""))
