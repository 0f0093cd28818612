from pyspark.sql import functions as F

from susurrus.functions import rules

LEX = ["brushing", "wiping", "rubbing", "scraping", "bubbling", "crushing", "pressing", "tapping", "blowing", "licking"]
SCHEMA = "raw string, s string, o string, label string, seen string, title string, want string"


def run(spark, rows, f):
    df = spark.createDataFrame([(*r[:-1], repr(r[-1])) for r in rows], SCHEMA)
    got = df.select("want", f.alias("x")).collect()
    for r in got:
        have = tuple(r.x) if isinstance(r.x, tuple) else r.x
        assert repr(have) == r.want, (r.want, have)


def test_verbs(spark):
    c = F.col
    rows = [
        (None, "a", "b", None, None, None, (None, "missing")), (" FAIL ", "a", "b", None, None, None, (None, "missing")), ("cleaning", "soft brush", "ear", None, None, None, ("brushing", "rule_cleaning")), ("cleaning", "cotton pad", "mic", None, None, None, ("wiping", "rule_cleaning")),
        ("cleaning", "finger", "ear", None, None, None, ("rubbing", "rule_cleaning")), ("cleaning", "finger pick", "ear", None, None, None, ("scraping", "rule_cleaning")), ("cleaning", None, None, None, "a microphone", None, ("scraping", "rule_cleaning")), ("cleaning", "brush", "table", None, None, None, (None, "unmapped")),
        ("Cleaning", "brush", "ear", None, None, None, (None, "unmapped")), ("melting", "a", "b", "Bath Bomb", "leaves rustle", None, ("pressing", "rule_melting")), ("melting", "a", "b", "bath bomb", "white foam", None, ("bubbling", "rule_melting")), ("melting", "a", "b", None, "white foam", None, ("crushing", "rule_melting")),
        ("melting", "a", "b", None, "it dissolves", None, ("bubbling", "rule_melting")), (" Tapping", "a", "b", None, None, None, ("tapping", "lexicon")), ("pat ting", "a", "b", None, None, None, ("tapping", "alias")), ("odd", "a", "b", None, None, None, (None, "unmapped")),
    ]
    run(spark, rows, rules.resolved_verb(c("raw"), c("s"), c("o"), c("label"), c("seen"), LEX, {"pat_ting": "tapping", "odd": "not_in_lexicon"}))


def test_liquids_equal_nouns_and_pictures(spark):
    c = F.col
    blow = rules.blown_liquid(c("raw"), c("s"), c("o"), c("label"), c("seen"), c("title"))
    run(spark, [
        ("blowing", "mouth", "straw", "into water", "soapy", None, ("bubbling", "air", "soapy water", "blow_liquid_to_bubbling")), ("blowing", "mouth", "straw", "in water", "an orb", None, ("bubbling", "air", "plastic spheres", "blow_liquid_to_bubbling")),
        ("blowing", "mouth", "mic", "effervescent", None, None, ("blowing", "mouth", "mic", None)), ("tapping", "a", "b", "water", None, None, ("tapping", "a", "b", None)), (None, None, None, None, None, None, (None, None, None, None)),
    ], blow)
    run(spark, [
        ("brushing", "hair", "hair", None, None, None, ("brush", "hair", "hair_brush_subject")), ("tapping", "nails", "nails", "Click", "a mic", None, ("nails", "mic", "clicking_mic")), ("tapping", "fingernails", "fingernails", "click", None, None, ("nails", "hard surface", "clicking_surface")),
        ("cutting", "soap", "soap", None, "two hands", None, ("hands", "soap", "crushing_soap")), ("cutting", "soap", "soap", None, None, None, ("metal tool", "soap", "carving_soap")), ("rubbing", "mic", "mic", None, None, None, ("hands", "mic", "mic_rubbing_hands")),
        ("rubbing", "x", "x", "Modeling pack", None, None, ("modeling pack", "silicone ear", "modeling_pack_subject")), ("rubbing", "x", "x", None, None, None, ("x", "x", None)), ("cutting", "soap", "wax", None, None, None, ("soap", "wax", None)), ("cutting", "fail", "fail", None, None, None, ("fail", "fail", None)),
    ], rules.apart(c("s"), c("raw"), c("o"), c("label"), c("seen")))
    run(spark, [("fail", None, None, "kissing", None, None, "licking"), ("fail", None, None, "slime", "stretch", None, "crunching"), ("fail", None, None, None, "stretch", None, None), ("fail", None, None, None, "a tap", None, "rubbing"), ("x", None, None, "kissing", None, None, None)], rules.seen_verb(c("raw"), c("label"), c("seen")))
    run(spark, [(None, "Pink unicorn", None, None, None, None, "plastic toy"), (None, "horse", None, None, None, None, "horse"), (None, None, None, None, None, None, None)], rules.prop(c("s")))


def test_whole_rows(spark):
    rows = [("cleaning", "Blue cotton swab", "ear", "ear cleaning", None, None, "-"), ("fail", "unicorn", "fail", "x", "they rub it", None, "-"), ("blowing", "lips", "water", "in water", None, None, "-"), ("zzz", None, "hand", None, None, None, "-")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r)[-7:] for r in rules.normalized(df, "raw", "s", "o", "label", "seen", "title", LEX, {}).collect()]
    assert got == [
        ("wiping", "cotton swab", "silicone ear", "rule_cleaning", None, "cotton swab wiping silicone ear", ""), ("rubbing", "plastic toy", "fail", "rule_visual", None, "plastic toy rubbing", "object_fail"),
        ("bubbling", "air", "water", "lexicon", "blow_liquid_to_bubbling", "air bubbling water", ""), (None, None, "hands", "unmapped", None, "hands", "verb_fail"),
    ]


def test_shortlists(spark):
    df = spark.createDataFrame([(1, ["Soft Strike", "none", "soft_strike", "crumple", "squash"]), (2, ["crumple"]), (3, ["none"]), (4, None)], "k int, c array<string>")
    got = {r.k: r.s for r in df.select("k", rules.shortlist(F.col("c"), ["soft_strike", "crumple", "squash"]).alias("s")).collect()}
    assert got == {1: ["soft_strike", "crumple"], 2: ["crumple", "crumple"], 3: [], 4: None}
    own = spark.createDataFrame([(None, ["a"]), (" b ", ["a"]), ("", [])], "o string, c array<string>")
    assert [r[0] for r in own.select(rules.event_class(F.col("o"), F.col("c"))).collect()] == ["a", "b", ""]
