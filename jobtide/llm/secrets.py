"""Secret scans by a trigram inverted index.

From each rule's pattern a Boolean query over trigrams is derived: every match holds one
of some sets of literal runs, and so all trigrams of that run. Postings of the rules'
trigrams are built over all documents, the queries intersect them, and only documents that
pass are matched against the pattern. A rule without mandatory trigrams scans everything.

All of it is DataFrame work. Postings are made distinct before they are moved: each
document sends one row of bits.
"""

from __future__ import annotations

import re
import re._constants as sre
import re._parser as parser
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``least`` is the shortest accepted length of ``group``."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: Patterns of the kinds of secret.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[A-Za-z0-9+/=\x20\x09-\x0D]+-----END [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"://[A-Za-z0-9._-]{1,64}:[^\x20\x09-\x0D:/@]{4,64}@[A-Za-z0-9]"),
)
RULES = BASE + MORE


def _runs(node) -> list[frozenset[str]] | None:
    """Alternatives of a parsed pattern; of each, literal runs that every match holds, in lower case. None: nothing is known."""
    done, open_runs = [frozenset()], [""]  # alternatives, and the run each ends with

    def close():
        nonlocal done, open_runs
        done = [a | {r} if len(r) > 2 else a for a, r in zip(done, open_runs, strict=True)]
        open_runs = [""] * len(done)

    for kind, value in node:
        if kind is sre.LITERAL:
            open_runs = [r + chr(value).lower() for r in open_runs]
        elif kind is sre.SUBPATTERN or kind in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            least, inner = (1, value[3]) if kind is sre.SUBPATTERN else (value[0], value[2])
            if kind is not sre.SUBPATTERN or len(inner) != 1 or inner[0][0] is not sre.BRANCH:
                found = _runs(inner) if least else None
            else:
                found = _runs(inner)
            close()
            if found:
                done = [a | b for a in done for b in found]
                open_runs = [""] * len(done)
        elif kind is sre.BRANCH:
            close()
            found = [_runs(x) for x in value[1]]
            done = [a | b for a in done for x in found for b in (x or [frozenset()])]
            open_runs = [""] * len(done)
        else:
            close()
    close()
    return done


def trigram_query(pattern: str) -> list[list[str]]:
    """Alternatives of trigrams in lower case, one of which every match holds in full; empty if there is no such query."""
    found = _runs(parser.parse(pattern))
    grams = [sorted({run[i : i + 3] for run in runs for i in range(len(run) - 2)}) for runs in found]
    if not all(grams):
        return []
    least = [g for g in grams if not any(set(h) < set(g) for h in grams)]
    return [list(g) for g in dict.fromkeys(map(tuple, least))]


def postings(docs: DataFrame, grams: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """The inverted index: a row (gram, key) for each of ``grams`` that a document holds, in either case."""
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    lowered = docs.select(key, low.alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams]))
    return lowered.select(F.explode(held).alias("gram"), key)


def candidates(index: DataFrame, rules: tuple[Rule, ...], key: str = "doc_id") -> DataFrame:
    """Documents whose postings satisfy a rule's query: key, kinds. Rules without a query are not in it."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    grams = sorted({g for q in queries.values() for a in q for g in a})
    bit = F.create_map(*[x for i, g in enumerate(grams) for x in (F.lit(g), F.lit(1 << i % 60))])
    words = {g: i // 60 for i, g in enumerate(grams)}
    word = F.create_map(*[x for g in grams for x in (F.lit(g), F.lit(words[g]))])
    n = max(words.values(), default=0) + 1
    sums = [
        F.bit_or(F.when(word[F.col("gram")] == w, bit[F.col("gram")]).otherwise(F.lit(0).cast("long"))).alias(f"b{w}")
        for w in range(n)
    ]
    held = index.groupBy(key).agg(*sums)

    def all_of(alternative: list[str]) -> Column:
        tests = []
        for w in range(n):
            if mask := sum(1 << i % 60 for i, g in enumerate(grams) if words[g] == w and g in alternative):
                tests.append(F.col(f"b{w}").bitwiseAND(F.lit(mask)) == F.lit(mask))
        out = tests[0]
        for t in tests[1:]:
            out = out & t
        return out

    kinds = []
    for kind, query in queries.items():
        hit = all_of(query[0])
        for alternative in query[1:]:
            hit = hit | all_of(alternative)
        kinds.append(F.when(hit, F.lit(kind)))
    return held.select(key, F.array_compact(F.array(*kinds)).alias("kinds")).filter(F.size("kinds") > 0)


def running(values: Column, of: Callable[[Column, Column], Column]) -> Column:
    """Each element of an array put together with all before it by an associative ``of``, such as a sum or a maximum.

    By doubling: after step s an element stands for itself and the 2s - 1 before it, so n log n
    elements are made, where growing an array by one at a time makes n squared.
    """

    def doubled(all_: Column) -> Column:
        steps = F.filter(F.array(*[F.lit(1 << i) for i in range(31)]), lambda s: s < F.size(all_))
        return F.aggregate(steps, all_, lambda acc, s: F.transform(acc, lambda x, i: F.when(i >= s, of(F.get(acc, i - s), x)).otherwise(x)))

    return bound(values, doubled)


def bound(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of`` a value that is computed once, however often ``of`` names it."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def matches(text: Column, rule: Rule) -> Column:
    """Spans (start, end, kind) of a rule in a text, in code points, end exclusive; leftmost, non-overlapping."""
    pattern = rule.pattern
    if rule.group == 0 and rule.least > 1 and re.fullmatch(r".*\[[^]]*\]\+", pattern):
        # a run of one class to its end: no shorter run can start inside it, so the engine may skip short ones at once
        head = re.sub(r"\[[^]]*\]\+$", "", pattern)
        pattern = pattern[:-1] + f"{{{rule.least - len(head)},}}"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    checked = F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.group))
    between = F.split(text, pattern, -1)
    pieces = F.arrays_zip(
        F.transform(found, F.length).alias("m"),
        F.transform(checked, F.length).alias("g"),
        F.transform(between, F.length).alias("b"),
    )
    pieces = F.filter(pieces, lambda p: p["m"].isNotNull())

    def placed(all_: Column) -> Column:
        # a match ends where all before it, and what stands between, ends
        ends = running(F.transform(all_, lambda p: (p["b"] + p["m"]).cast("long")), lambda a, b: a + b)
        spans = F.filter(F.arrays_zip(all_.alias("p"), ends.alias("e")), lambda x: x["p"]["g"] >= rule.least)
        return F.transform(
            spans, lambda x: F.struct((x["e"] - x["p"]["m"]).alias("start"), x["e"].alias("end"), F.lit(rule.kind).alias("kind"))
        )

    kept = bound(pieces, placed)
    none = F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>")
    return F.when(text.rlike(pattern), kept).otherwise(none)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with secrets, the array of spans (start, end, kind) by start, then by order of ``rules``.

    Null and empty texts have none. Rows with equal keys are scanned each on its own: a
    key that is a candidate by one row only costs a needless match. A row with a null key
    is matched against every rule. A column named secrets is replaced.
    """
    indexed = [r for r in rules if trigram_query(r.pattern)]
    body = F.coalesce(F.col(text), F.lit(""))
    kept = [c for c in docs.columns if c.lower() not in ("secrets", "_kinds", "_key")]
    if indexed:
        grams = sorted({g for r in indexed for a in trigram_query(r.pattern) for g in a})
        found = candidates(postings(docs.filter(F.col(key).isNotNull()), grams, key, text), rules, key)
        found = found.select(F.col(key).alias("_key"), F.col("kinds").alias("_kinds"))
        docs = docs.select(*kept).join(found, F.col(key) == F.col("_key"), "left")
    none = F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>")
    parts = []
    for rule in rules:
        spans = matches(body, rule)
        if rule in indexed:
            spans = F.when(F.array_contains("_kinds", rule.kind) | F.col(key).isNull(), spans).otherwise(none)
        parts.append(spans)
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    spans = F.transform(
        F.flatten(F.array(*parts)),
        lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("o"), s["end"].alias("end"), s["kind"].alias("kind")),
    )
    spans = F.transform(
        F.sort_array(spans), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
    )
    return docs.select(*kept, spans.alias("secrets"))


def joined(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """``text`` with each stretch that spans cover replaced by ``mark``; spans may overlap."""

    def marked(blocks: Column, reach: Column) -> Column:
        def piece(s: Column, i: Column) -> Column:
            before = F.coalesce(F.get(reach, i - 1), F.lit(0).cast("long"))
            return F.when(s["start"] >= before, F.concat(_cut(blocks, before, s["start"]), F.lit(mark))).otherwise(F.lit(""))

        return F.concat(F.array_join(F.transform(spans, piece), ""), _cut(blocks, F.element_at(reach, -1), F.length(text).cast("long")))

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    # how far the spans up to each one reach; a span that begins within that is marked already
    reach = running(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
    whole = bound(blocks, lambda b: bound(reach, lambda r: marked(b, r)))
    return F.when(F.size(spans) > 0, whole).otherwise(text)


#: Code points of a block; a place in a text is found within its block.
BLOCK = 4096


def _cut(blocks: Column, start: Column, end: Column) -> Column:
    """Code points [start, end) of a text that is cut into blocks."""
    first, last = F.floor(start / BLOCK).cast("int"), F.floor(end / BLOCK).cast("int")
    at, upto = (start % BLOCK).cast("int"), (end % BLOCK).cast("int")
    block = lambda i: F.coalesce(F.get(blocks, i), F.lit(""))
    across = F.concat(
        F.substr(block(first), at + 1), F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), ""), F.substr(block(last), F.lit(1), upto)
    )
    return F.when(first == last, F.substr(block(first), at + 1, upto - at)).otherwise(across)
