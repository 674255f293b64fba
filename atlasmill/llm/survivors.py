"""Best representative of each duplicate group: a latent two-sided quality model of sources and claims, field by field.

Each source has, for each field, a sensitivity (chance to claim a true value of an entity it speaks of) and a false-claim rate (1 - specificity).
A value of a group is true or not; members of the group that hold another value speak against it. Expectation and maximisation alternate over
all claims. A text that is claimed in many unrelated groups and confirmed in none of them is a stand-in for a missing value: how credible
a text is, is a second latent quantity, fitted over all groups in which it stands. Only the numbers of the sources travel to the driver.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasmill.functions.visible import skeleton_col
from atlasmill.session import materialize
from atlasmill.tables import small

#: What a value of a field must hold to be of the field's kind at all: two Arabic letters, a digit. Other fields need any visible character.
FORMATS = {"name_ar": "[\\u0621-\\u064A].*[\\u0621-\\u064A]", "hours": "[0-9\\u0660-\\u0669]"}
#: Sources are a fixed, small set; more than so many are refused.
MAX_SOURCES = 10_000
#: Chance that a claim is true, and that a text never seen before is a value.
PRIOR_TRUE, PRIOR_VALUE = 0.7, 0.99
#: Members of a group that count for a text, at most: a group of any size is one witness among others.
LISTENERS = 3
#: Fields in which values are confirmed more often than stand-ins by less than this confirm nothing: there, every text of the right format is kept.
LEAST_YOUDEN = 0.25


def well_formed(field: Column, skeleton: Column) -> Column:
    """Whether a text (its skeleton) is of the kind of the field: FORMATS, else anything visible."""
    ok = F.coalesce(skeleton, F.lit("")) != ""
    for name, pattern in FORMATS.items():
        ok = ok & ((field != name) | skeleton.rlike(pattern))
    return F.coalesce(ok, F.lit(False))


def quality_model(claims: DataFrame, rounds: int = 6) -> tuple[DataFrame, dict[tuple[str, str], tuple[float, float]]]:
    """claims (group, field, value, source) -> (group, field, value, llr), and (sensitivity, specificity) of each (field, source).

    A value may be true beside others: each is judged alone, from who claims it and who of the group claims another. llr is the logarithm of how
    much likelier the claims are if the value is true. Facts with the same pattern of claimants count together, so a round costs as much as
    there are patterns. Sources are taken from the claims (at most MAX_SOURCES, checked).
    """
    spark = claims.sparkSession
    names = [tuple(r) for r in claims.select("field", "source").distinct().orderBy("field", "source").limit(MAX_SOURCES + 1).collect()]
    if len(names) > MAX_SOURCES:
        raise ValueError("the quality model expects a fixed, small set of sources")
    numbered = spark.createDataFrame([(f, s, i) for i, (f, s) in enumerate(names)], "field string, source string, s int")
    said = claims.join(small(numbered, MAX_SOURCES), ["field", "source"])
    given = said.groupBy("group", "field", "value").agg(F.array_sort(F.collect_set("s")).alias("yes"))
    there = said.groupBy("group", "field").agg(F.array_sort(F.collect_set("s")).alias("all"))
    facts = given.join(there.hint("merge"), ["group", "field"]).select("group", "field", "value", "yes", F.array_except("all", "yes").alias("no"))
    facts = materialize(facts, "facts")
    patterns = materialize(facts.groupBy("yes", "no").agg(F.count("*").alias("n")), "patterns")
    sens, fall = [0.8] * len(names), [0.1] * len(names)

    def evidence() -> Column:
        pro = F.lit([log(a / b) for a, b in zip(sens, fall)] or [0.0])
        con = F.lit([log((1 - a) / (1 - b)) for a, b in zip(sens, fall)] or [0.0])
        return F.aggregate("no", F.aggregate("yes", F.lit(0.0), lambda t, s: t + F.get(pro, s)), lambda t, s: t + F.get(con, s))

    for _ in range(rounds if names else 0):
        p = 1 / (1 + F.exp(-(evidence() + log(PRIOR_TRUE / (1 - PRIOR_TRUE)))))
        scored = patterns.select("yes", "no", "n", p.alias("p"))
        votes = [scored.select(F.explode(c).alias("s"), F.lit(v).alias("said"), "n", "p") for c, v in (("yes", 1), ("no", 0))]
        sums = votes[0].unionAll(votes[1]).groupBy("s").agg(
            F.sum(F.col("n") * F.col("p")).alias("true"), F.sum(F.col("n") * F.col("p") * F.col("said")).alias("hit"),
            F.sum(F.col("n") * (1 - F.col("p"))).alias("false"), F.sum(F.col("n") * (1 - F.col("p")) * F.col("said")).alias("loud"),
        )
        for r in sums.collect():
            sens[r["s"]], fall[r["s"]] = _within((r["hit"] + 8) / (r["true"] + 10)), _within((r["loud"] + 1) / (r["false"] + 10))
    return facts.select("group", "field", "value", evidence().alias("llr")), {k: (a, 1 - b) for k, a, b in zip(names, sens, fall)}


def _within(p: float) -> float:
    return min(0.99, max(0.01, p))


def confirmations(claims: DataFrame) -> tuple[DataFrame, DataFrame]:
    """claims (group, field, text, source), one a member -> (group, field, text, value, sources) and, of every text, its groups and confirmations.

    Spellings of one value confirm each other: a text that differs from the group's most frequent text (of equally frequent ones the
    globally rarer) in at most a quarter of its letters, or goes on where the other ends, speaks for the same value. heard counts the other members of a text's groups, at most LISTENERS a group, and yes
    the share of them that speak for its value.
    """
    held = materialize(claims.groupBy("group", "field", "text").agg(F.count("*").alias("c"), F.collect_set("source").alias("sources")), "held")
    spread = held.groupBy("field", "text").agg(F.count("*").alias("groups"))
    ranked = held.join(spread.hint("merge"), ["field", "text"])
    modal = ranked.groupBy("group", "field").agg(F.max(F.struct("c", -F.col("groups"), "text"))["text"].alias("modal"), F.sum("c").alias("speakers"))
    near = F.levenshtein("text", "modal") * 4 <= F.greatest(F.length("text"), F.length("modal"))
    near = near | F.startswith("text", "modal") | F.startswith("modal", "text")
    named = held.join(modal.hint("merge"), ["group", "field"]).withColumn("value", F.when(near, F.col("modal")).otherwise(F.col("text")))
    named = materialize(named, "named")
    votes = named.groupBy("group", "field", "value").agg(F.sum("c").alias("votes"))
    heard = F.least(F.col("speakers") - 1, F.lit(LISTENERS)).cast("double")
    yes = F.when(F.col("speakers") > 1, heard * (F.col("votes") - 1) / (F.col("speakers") - 1)).otherwise(0.0)
    met = named.join(votes.hint("merge"), ["group", "field", "value"])
    texts = met.groupBy("field", "text").agg(F.count("*").alias("groups"), F.sum(heard).alias("heard"), F.sum(yes).alias("yes"))
    return named, materialize(texts, "texts")


def credible_texts(claims: DataFrame, rounds: int = 6) -> DataFrame:
    """claims (group, field, text, source), one a member -> (group, field, text, credible, p_true): every text of a group, judged.

    credible is the chance that the text is a value at all and not a stand-in. Of each field two numbers are latent: how often the other members of
    a group confirm a value (sensitivity) and how often a stand-in (1 - specificity). They and the texts' chances alternate
    (expectation-maximisation). A text is judged by its other groups, so one that stands in a single group keeps PRIOR_VALUE. Where the two
    numbers differ by less than LEAST_YOUDEN, or most of what is heard would be stand-ins, members of the field do not confirm each other, and
    every text is kept. p_true adds
    who claims the value in this group, by the sources' own sensitivity and specificity (quality_model).
    """
    named, texts = confirmations(claims)
    fields = [r[0] for r in texts.select("field").distinct().collect()]
    rates = {f: (0.8, 0.1, 1.0) for f in fields}
    chance = F.lit(PRIOR_VALUE)
    for _ in range(rounds + 1):
        gain, loss, apart = F.lit(0.0), F.lit(0.0), F.lit(False)
        for f, (r, q, share) in rates.items():
            here = F.col("field") == f
            gain, loss, apart = F.when(here, log(r / q)).otherwise(gain), F.when(here, log((1 - r) / (1 - q))).otherwise(loss), F.when(here, r - q >= LEAST_YOUDEN and share >= 0.5).otherwise(apart)
        others = (F.col("yes") * gain + (F.col("heard") - F.col("yes")) * loss) * (F.col("groups") - 1) / F.col("groups")
        chance = 1 / (1 + F.exp(-F.least(F.lit(50.0), F.greatest(F.lit(-50.0), others + log(PRIOR_VALUE / (1 - PRIOR_VALUE))))))
        sums = texts.withColumn("p", chance).groupBy("field").agg(
            F.sum(F.col("p") * F.col("yes")).alias("a"), F.sum(F.col("p") * F.col("heard")).alias("b"), F.sum((1 - F.col("p")) * F.col("yes")).alias("c"), F.sum((1 - F.col("p")) * F.col("heard")).alias("d")
        )
        rates = {r["field"]: (_within((r["a"] + 1.6) / (r["b"] + 2)), _within((r["c"] + 0.2) / (r["d"] + 2)), (r["b"] + 2) / (r["b"] + r["d"] + 2)) for r in sums.collect()}
    known = texts.select("field", "text", F.when(apart, chance).otherwise(PRIOR_VALUE).alias("credible"))
    facts, _ = quality_model(named.select("group", "field", "value", F.explode("sources").alias("source")), rounds)
    out = named.select("group", "field", "text", "value").join(facts.hint("merge"), ["group", "field", "value"]).join(known.hint("merge"), ["field", "text"])
    sure = F.least(F.lit(0.999), F.greatest(F.lit(0.001), F.col("credible")))
    return out.select("group", "field", "text", "credible", (1 / (1 + F.exp(-(F.log(sure / (1 - sure)) + F.col("llr"))))).alias("p_true"))


def judged_members(members: DataFrame, sources: DataFrame, rounds: int = 6, judge=credible_texts) -> DataFrame:
    """members (group, field, source_key, source, harvested_at, value) that hold a value of their field, with weight, credible and p_true.

    Several rows of one member count as one (the newest). Blanks, nulls and texts of the wrong format are no values; of the others every text
    whose credibility is below a half is a stand-in and dropped. weight is sources.reliability_weight, 0.5 where null or unlisted.
    """
    shown = members.withColumn("skeleton", skeleton_col(F.col("value"))).filter(well_formed(F.col("field"), F.col("skeleton")))
    newest = F.max(F.struct("harvested_at", "value", "source", F.lower("skeleton").alias("text")))
    keyed = shown.filter(F.col("group").isNotNull() & F.col("source_key").isNotNull() & F.col("source").isNotNull())
    one = keyed.groupBy("group", "field", "source_key").agg(newest.alias("m")).select("group", "field", "source_key", "m.*")
    weights = sources.groupBy(F.col("name").alias("source")).agg(F.max("reliability_weight").alias("weight"))
    one = materialize(one.join(small(weights), "source", "left").withColumn("weight", F.coalesce("weight", F.lit(0.5))), "members")
    judged = judge(one.select("group", "field", "text", "source"), rounds).filter("credible >= 0.5")
    return one.join(judged.hint("merge"), ["group", "field", "text"]).withColumn("at", F.coalesce(F.unix_micros("harvested_at"), F.lit(-(2**62))))


def survivors(members: DataFrame, sources: DataFrame, rounds: int = 6, judge=credible_texts) -> DataFrame:
    """group, field_name, source_key, value, p_true, dominant: the surviving member of each group and field that has a value.

    members as for judged_members(), which says what counts as a value. The survivor is the member that beats every other one holding a value by a
    strictly greater weight and a strictly later harvested_at (`dominant`); where there is none, the one with the most probable value, then the
    greater weight, later date and smaller key. A group without a value gives no row. A null harvested_at beats nobody and loses
    to any date. Equal members tie and so none of them is dominant. Other columns are not read. All by aggregates that are combined
    before they are shuffled, so a group of any size is no single task's.
    """
    scored = materialize(judged_members(members, sources, rounds, judge), "scored")
    best = scored.groupBy("group", "field").agg(F.max("weight").alias("most"), F.max("at").alias("last"))
    met = scored.join(best.hint("merge"), ["group", "field"])
    ahead = (F.col("weight") == F.col("most")) & (F.col("at") == F.col("last"))
    first = F.max_by(F.struct("source_key", "value", "p_true"), F.struct(ahead, "p_true", "weight", "at", "source_key"))
    alone = (F.count_if(F.col("weight") == F.col("most")) == 1) & (F.count_if(F.col("at") == F.col("last")) == 1) & (F.count_if(ahead) == 1)
    by_model = F.max_by(F.struct("source_key", "value", "p_true"), F.struct("p_true", "weight", "at", "source_key"))
    picked = met.groupBy("group", "field").agg(F.when(alone, first).otherwise(by_model).alias("m"), alone.alias("dominant"))
    return picked.select("group", F.col("field").alias("field_name"), "m.source_key", "m.value", "m.p_true", "dominant")


def true_values(members: DataFrame, sources: DataFrame, rounds: int = 6, keep: float = 0.5) -> DataFrame:
    """group, field_name, value, p_true: every distinct value judged true (p_true >= keep); a field may keep several."""
    scored = judged_members(members, sources, rounds).filter(F.col("p_true") >= keep)
    return scored.groupBy("group", F.col("field").alias("field_name"), "value").agg(F.max("p_true").alias("p_true"))
