"""Quality rules: an ordered decision list learned by sequential covering.

Texts are reduced to a few counts, all by DataFrame expressions. From labelled counts one
rule after another is grown, a conjunction of thresholds chosen by FOIL's information gain,
then pruned on rows that were held back from growing, and what it covers is set aside. The
list is applied as one ordered CASE expression.

What a step gathers is a count by feature and bin, whatever the number of rows. All
labelled rows take part; there is no sample.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.llm.text import SPACES, words

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
#: Window positions take so many bits beside their hash.
_BITS = 21

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct", "n_lines", "n_bangs", "n_capitals", "n_digits")


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        side = F.col(self.feature)
        return side >= self.threshold if self.above else side < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _repeat_pairs(w: Column, n: Column) -> Column:
    """Neighbouring starts (a, b) of equal windows of three words, by hash; ``same`` tells whether their words are equal too."""
    triples = F.arrays_zip(F.slice(w, 1, n - 2).alias("x"), F.slice(w, 2, n - 2).alias("y"), F.slice(w, 3, n - 2).alias("z"))
    packed = F.transform(
        triples,
        lambda t, i: F.shiftleft(F.xxhash64(t["x"], t["y"], t["z"]), _BITS).bitwiseOR(i.cast("long")),
    )
    return F.sort_array(packed)


def _low(x: Column) -> Column:
    return x.bitwiseAND(F.lit((1 << _BITS) - 1)).cast("int")


def counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and the counts of COUNTS of each whole text, one row per row of ``docs``; null texts have none.

    n_repeat_words counts the words in windows of three that the text holds twice or more.
    Windows are sorted by hash and place, and neighbours of equal hash compared word by
    word; should two different windows share a hash, or a text have two million words, the
    windows themselves are sorted.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    df = docs.select(F.col(key).alias("_k"), body.alias("_t"), words(body).alias("_w"))
    lines = F.filter(F.split("_t", "\n"), lambda s: F.translate(s, SPACES, "") != "")
    drop = lambda chars: F.length("_t") - F.length(F.translate("_t", chars, ""))
    df = df.select(
        "_k",
        "_w",
        F.size("_w").alias("_n"),
        lines.alias("_l"),
        F.length(F.translate("_t", SPACES, "")).alias("word_chars"),
        drop(SYMBOLS).alias("n_symbols"),
        drop("!").alias("n_bangs"),
        drop("ABCDEFGHIJKLMNOPQRSTUVWXYZÀÂÄÇÈÉÊËÍÎÏÑÓÔÖÙÚÛÜ").alias("n_capitals"),
        drop("0123456789").alias("n_digits"),
    )
    df = df.select(
        "_k", "_w", "_n", "word_chars", "n_symbols", "n_bangs", "n_capitals", "n_digits",
        F.size("_l").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).alias("n_dup_lines"),
        F.size(F.array_distinct("_w")).alias("n_distinct"),
        F.when(F.col("_n").between(3, (1 << _BITS) - 1), _repeat_pairs(F.col("_w"), F.col("_n"))).alias("_s"),
    )
    same_hash = lambda a, b: F.shiftright(a.bitwiseXOR(b), _BITS) == 0
    neighbours = F.zip_with(
        "_s",
        F.slice("_s", F.lit(2), F.greatest(F.size("_s"), F.lit(1))),
        lambda a, b: F.when(same_hash(a, b), F.struct(_low(a).alias("a"), _low(b).alias("b"))),
    )
    df = df.withColumn("_p", F.array_compact(neighbours))
    at = lambda i, k: F.col("_w")[i + k]
    unequal = F.exists(
        "_p", lambda p: (at(p["a"], 0) != at(p["b"], 0)) | (at(p["a"], 1) != at(p["b"], 1)) | (at(p["a"], 2) != at(p["b"], 2))
    )
    by_hash = F.flatten(F.transform("_p", lambda p: F.array(p["a"], p["b"])))
    places = F.sequence(F.lit(0), F.col("_n") - 3)
    whole = F.sort_array(
        F.transform(places, lambda i: F.struct(at(i, 0).alias("x"), at(i, 1).alias("y"), at(i, 2).alias("z"), i.alias("i")))
    )
    equal = lambda a, b: (a["x"] == b["x"]) & (a["y"] == b["y"]) & (a["z"] == b["z"])
    by_words = F.flatten(
        F.array_compact(
            F.zip_with(
                whole, F.slice(whole, F.lit(2), F.col("_n")), lambda a, b: F.when(equal(a, b), F.array(a["i"], b["i"]))
            )
        )
    )
    places = F.when(F.col("_n") < 3, F.array().cast("array<int>"))
    places = places.when(F.col("_s").isNotNull() & ~unequal, by_hash).otherwise(by_words)
    df = df.withColumn("_r", F.sort_array(F.array_distinct(places)))
    following = F.concat(F.slice("_r", F.lit(2), F.greatest(F.size("_r"), F.lit(1))), F.array(F.lit(2**31 - 1)))
    covered = F.zip_with("_r", following, lambda a, b: F.least(F.lit(3).cast("long"), b.cast("long") - a))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda x, y: x + y)
    df = df.withColumn("n_repeat_words", F.when(F.size("_r") == 0, F.lit(0).cast("long")).otherwise(total))
    return df.select(F.col("_k").alias(key), F.col("_n").alias("n_words"), *COUNTS[1:]).select(
        key, *[F.col(c).cast("long").alias(c) for c in COUNTS]
    )


def base_failed() -> Column:
    """The fixed rules that come before the learned ones."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def features() -> dict[str, Column]:
    """What conditions are about: shares, which do not depend on a text's length."""
    per_word = {c: F.col(c) / F.greatest("n_words", F.lit(1)) for c in ("word_chars", "n_symbols", "n_repeat_words", "n_distinct", "n_bangs")}
    per_char = {c: F.col(c) / F.greatest("word_chars", F.lit(1)) for c in ("n_capitals", "n_digits")}
    return {f"{c}_per_word": v for c, v in per_word.items()} | {f"{c}_per_char": v for c, v in per_char.items()} | {
        "dup_line_share": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "words_per_line": F.col("n_words") / F.greatest("n_lines", F.lit(1)),
    }


def covers(rule: Rule) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column()
    return out


def _purity(p: float, n: float) -> float:
    return p / (p + n) if p + n else 0.0


def learn(
    labelled: DataFrame, names: list[str], bad: str = "bad", key: str = "doc_id", bins: int = 32, most_rules: int = 12,
    most_conditions: int = 4, least_purity: float = 0.9, least_covered: int = 5,
) -> list[Rule]:
    """A decision list for rows whose ``bad`` is 1, from columns ``names``; rows with a null label or feature take no part.

    A third of the rows, by hash of the key, is kept for pruning. A rule is accepted if
    ``least_purity`` of what it covers there is bad. No labels, or labels of one class
    only, give an empty list.
    """
    rows = labelled.filter(F.col(bad).isNotNull()).select(
        F.col(bad).cast("int").alias("_bad"), (F.abs(F.xxhash64(key)) % 3 == 0).alias("_prune"), *names
    ).na.drop().cache()
    try:
        cuts = rows.select(*[F.percentile_approx(n, [i / bins for i in range(1, bins)], 10_000).alias(n) for n in names]).first()
        cuts = {n: sorted(set(cuts[n] or [])) for n in names}
        rules: list[Rule] = []
        left = F.lit(True)
        while len(rules) < most_rules:
            rule: Rule = ()
            while len(rule) < most_conditions:
                found = _best(rows.filter(left & ~F.col("_prune") & covers(rule)), cuts)
                if found is None:
                    break
                rule = (*rule, found[0])
                if found[1] == 0:
                    break
            if not rule:
                break
            held = rows.filter(left & F.col("_prune")).select(
                *[F.sum(F.when(covers(rule[:k]), x).otherwise(0)).alias(f"{s}{k}") for k in range(1, len(rule) + 1) for s, x in (("p", F.col("_bad")), ("n", 1 - F.col("_bad")))]
            ).first()
            worth = {k: _purity(held[f"p{k}"] or 0, held[f"n{k}"] or 0) for k in range(1, len(rule) + 1)}
            k = max(worth, key=lambda k: (worth[k], held[f"p{k}"] or 0, -k))
            if worth[k] < least_purity or (held[f"p{k}"] or 0) < least_covered:
                break
            rules.append(rule[:k])
            left = left & ~covers(rule[:k])
        return rules
    finally:
        rows.unpersist()


def _best(rows: DataFrame, cuts: dict[str, list[float]]) -> tuple[Condition, int] | None:
    """The condition of the highest information gain, and the good rows it lets through; None if none gains."""
    bins = [
        F.struct(F.lit(n).alias("f"), sum((F.when(F.col(n) >= t, 1).otherwise(0) for t in ts), F.lit(0)).alias("b"))
        for n, ts in cuts.items()
        if ts
    ]
    if not bins:
        return None
    # at most a row for each feature and bin
    table = rows.select("_bad", F.explode(F.array(*bins)).alias("x")).groupBy("x.f", "x.b").agg(F.sum("_bad").alias("p"), F.count("*").alias("c")).collect()
    count: dict[str, dict[int, tuple[int, int]]] = {}
    for r in table:
        count.setdefault(r["f"], {})[r["b"]] = (r["p"], r["c"] - r["p"])
    best = None
    for name in sorted(count):
        total = [sum(v[i] for v in count[name].values()) for i in (0, 1)]
        if not total[0] or not total[1]:
            return None
        prior = math.log2(_purity(*total))
        for i, t in enumerate(cuts[name]):
            above = [sum(v[j] for b, v in count[name].items() if b > i) for j in (0, 1)]
            for side, (p, n) in ((True, above), (False, (total[0] - above[0], total[1] - above[1]))):
                if p and (gain := p * (math.log2(_purity(p, n)) - prior)) > 1e-9 and (best is None or gain > best[0]):
                    best = (gain, Condition(name, side, t), n)
    return best and (best[1], best[2])


def decision(rules: list[Rule]) -> Column:
    """The number of the first rule that covers a row, from 1; null if none does."""
    out = F.lit(None).cast("int")
    for i, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(covers(rule), F.lit(i)).otherwise(out)
    return out


def verdicts(counted: DataFrame, labels: DataFrame, key: str = "doc_id", quality: str = "quality") -> DataFrame:
    """``counted`` with base_failed, kept and rule, the number of the rule that rejects a row (null: none).

    The list is learned from the labelled rows that pass the base rules. Where a key is
    labelled more than once the lower label counts; keys that are null are not labelled.
    """
    made = features()
    counted = counted.select(*[c for c in counted.columns if c not in made], *[v.alias(n) for n, v in made.items()])
    labels = labels.groupBy(F.col(key).alias("_id")).agg(F.min(quality).alias("_q"))
    labelled = counted.filter(~base_failed()).join(labels, F.col(key) == F.col("_id"))
    rules = learn(labelled.withColumn("bad", F.when(F.col("_q") == 0, 1).when(F.col("_q") == 1, 0)), list(made), key=key)
    out = counted.withColumn("base_failed", base_failed()).withColumn("rule", decision(rules))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
