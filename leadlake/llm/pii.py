"""Personal data: pattern rules, and boosted trees over further candidates; Spark expressions only.

High-recall generators propose spans that may overlap each other and the rules' spans. Boosted trees score each by its format
(digits, groups, separators, check digit) and its context (neighbouring characters, words before it). They learn, on a bounded
sample, to tell proposals that lie on a rule's span from those that do not; the sign by which a rule decides (a leading plus,
an ``@``) is kept from them, so they also accept the same formats without it. Thresholds per kind are calibrated
on held-out proposals. Accepted proposals away from any rule's span are added to the rules' spans.

Nothing leaves the JVM but the sample's numbers: the flattened trees become one SQL expression.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.llm import boosting
from leadlake.llm.common import packed, unpacked

KINDS = ("email", "ip", "card", "phone")
# The rules. Possessive repeats and the guard in front change no match: a run that fails at its start fails everywhere
# in it. They keep long runs linear, and the matcher's stack flat.
_EMAIL_CHARS = "[A-Za-z0-9._%+-]"
_RULES = {
    "email": rf"(?:(?<!{_EMAIL_CHARS})|\G){_EMAIL_CHARS}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# Proposals: (kind, pattern, cheap test that a text can match at all).
GENERATORS = (
    ("email", r"(?<![\p{L}0-9._%+-])[\p{L}0-9._%+-]++\x20?+(?:@|\[at\]|\(at\))\x20?+[\p{L}0-9-]++"
              r"(?:\x20?+(?:\.|\[dot\]|\(dot\))\x20?+[\p{L}0-9-]++)++", r"@|\[at\]|\(at\)"),
    ("ip", r"(?<![0-9.])[0-9]{1,3}(?:[.,][0-9]{1,3}){3}(?![0-9])", r"[0-9][.,][0-9]"),
    ("card", r"(?<![0-9])[0-9](?:[\x20._/-]?[0-9]){11,18}(?![0-9])", r"[0-9]"),
    ("phone", r"(?<![0-9])\(?[0-9]{2,5}\)?(?:[\x20./-]{1,2}\(?[0-9]{2,5}\)?){1,4}(?![0-9])", r"[0-9]"),
)
CONTEXT = 24  # characters before a proposal that count as its context
HINTS = ("mail", "contact", "phone", "tel", "call", "fax", "card", "visa", "account", "address", "server", "host", "version")
FEATURES = ("kind", "length", "digits", "letters", "groups", "longest_group", "dots", "brackets", "separators", "luhn",
            "part_range", "letter_before", "letter_after", "symbol_before", "symbol_after", "hint")
# Documents drawn by a hash for the sample, and most proposals taken from them.
SAMPLE_DOCS = 20_000
MAX_PROPOSALS = 20_000
# Least share of accepted held-out proposals that must lie on a rule's span.
PRECISION = 0.99
# Steps of a unit of log-odds in which held-out proposals are counted.
STEPS = 256
TREES, DEPTH = 24, 3
# Characters of a cell of a text that is redacted.
CELL = 4096


# Items of a fold are taken in blocks of so many: Spark copies the state of a fold for each item, with all lists in it.
FOLD = 128
SPAN = "struct<start:int,end:int,hit:string,before:string,after:string>"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it occurs in there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def gathered(items: Column, zero: Column, step: Callable[[Column, Column], tuple[Column, Column, Column]], kind: str) -> Column:
    """Values of type ``kind`` from a fold over ``items``: ``step(state, item)`` gives the next state, a value, and whether it is kept.

    A first fold finds the state at the start of each block, a second one lists the values of each block; so no list longer than
    a block, and none longer than the number of blocks, is part of a state.
    """
    none = F.array().cast(f"array<{kind}>")

    def ahead(acc: Column, block: Column) -> Column:
        return F.struct(F.aggregate(block, acc["state"], lambda state, item: step(state, item)[0]).alias("state"),
                        F.array_append(acc["starts"], acc["state"]).alias("starts"))

    def listed(block: Column, start: Column) -> Column:
        def add(acc: Column, item: Column) -> Column:
            state, value, keep = step(acc["state"], item)
            return F.struct(state.alias("state"), F.when(keep, F.array_append(acc["kept"], value)).otherwise(acc["kept"]).alias("kept"))

        return F.aggregate(block, F.struct(start.alias("state"), none.alias("kept")), add, lambda acc: acc["kept"])

    def over(blocks: Column) -> Column:
        first = F.struct(zero.alias("state"), F.slice(F.array(zero), 1, 0).alias("starts"))
        return F.flatten(F.zip_with(blocks, F.aggregate(blocks, first, ahead, lambda acc: acc["starts"]), listed))

    def cut(whole: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.size(whole), F.lit(1)), F.lit(FOLD))
        return bound(F.transform(places, lambda at: F.slice(whole, at, F.lit(FOLD))), over)

    return bound(items, cut)


def spans_of(text: Column, pattern: str, valid: Callable[[Column], Column] = lambda hit: F.lit(True)) -> Column:
    """Leftmost non-overlapping matches that are ``valid`` as ``array<struct<start, end, hit, before, after>>`` in code points.

    The pieces between the matches and the matches themselves give the offsets, the CONTEXT characters before a match and the one
    after it, in one pass over the text.
    """
    pieces = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pair = F.zip_with(pieces, hits, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))
    first = lambda c: F.left(F.coalesce(c, F.lit("")), F.lit(1))

    def described(p: Column, q: Column) -> Column:
        return F.struct(p["gap"].alias("gap"), p["hit"].alias("hit"),
                        F.coalesce(p["hit"].isNotNull() & valid(p["hit"]), F.lit(False)).alias("ok"),
                        F.left(F.concat(first(q["gap"]), first(q["hit"])), F.lit(1)).alias("after"))

    near = bound(pair, lambda all_: F.zip_with(all_, F.slice(all_, 2, F.size(all_)), described))

    def step(state: Column, p: Column) -> tuple[Column, Column, Column]:
        begin = state["at"] + F.length(p["gap"])
        end = begin + F.coalesce(F.length(p["hit"]), F.lit(0))
        before = F.right(F.concat(state["tail"], p["gap"]), F.lit(CONTEXT))
        tail = F.right(F.concat(before, F.coalesce(p["hit"], F.lit(""))), F.lit(CONTEXT))
        span = F.struct(begin.alias("start"), end.alias("end"), p["hit"].alias("hit"), before.alias("before"), p["after"].alias("after"))
        return F.struct(end.alias("at"), tail.alias("tail")), span, p["ok"]

    return gathered(near, F.struct(F.lit(0).alias("at"), F.lit("").alias("tail")), step, SPAN)


def _none() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a digit string passes the Luhn check; only for up to 19 digits."""
    turned = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(turned, i, F.lit(1)).cast("int")
        twice = 2 * d - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)
    return F.when(F.length(digits).between(1, 19), total % 10 == 0).otherwise(False)


def rule_spans(text: Column, kind: str) -> Column:
    """Spans of a rule, without matches that fail its check."""
    n = lambda hit: F.length(digits_of(hit))
    valid, possible = {
        "email": (lambda hit: F.lit(True), F.contains(text, F.lit("@"))),
        "ip": (lambda hit: hit.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"), text.rlike(r"[0-9]\.[0-9]")),
        "card": (lambda hit: n(hit).between(12, 19) & luhn(digits_of(hit)), text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}")),
        "phone": (lambda hit: n(hit).between(9, 15), F.contains(text, F.lit("+"))),
    }[kind]
    return F.when(possible, spans_of(text, _RULES[kind], valid)).otherwise(_none())


def proposals(text: Column) -> Column:
    """All generators' spans with their features: ``array<struct<kind, start, end, f>>``."""
    def described(kind: str) -> Callable[[Column], Column]:
        return lambda span: features_of(kind, span)

    def features_of(kind: str, span: Column) -> Column:
        hit = span["hit"]
        digits = digits_of(hit)
        before, following = span["before"], span["after"]
        last = F.right(before, F.lit(1))
        groups = F.regexp_extract_all(hit, F.lit(r"[0-9]+"), F.lit(0))
        number = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
        count = lambda p: number(F.length(hit) - F.length(F.regexp_replace(hit, p, "")))
        values = (
            F.lit(float(KINDS.index(kind))), number(F.length(hit)), number(F.length(digits)), count(r"\p{L}"),
            number(F.size(groups)), number(F.array_max(F.transform(groups, lambda g: F.length(g)))), count(r"\."),
            count(r"[()\[\]]"), count(r"[\x20/_,-]"), number(luhn(digits)),
            number(F.forall(groups, lambda g: g.rlike(rf"^{_PART}$"))), number(last.rlike(r"\p{L}")),
            number(following.rlike(r"\p{L}")), number(last.rlike(r"[^\p{L}0-9\s]")), number(following.rlike(r"[^\p{L}0-9\s]")),
            number(F.lower(before).rlike("|".join(HINTS))),
        )
        return F.struct(F.lit(kind).alias("kind"), span["start"].alias("start"), span["end"].alias("end"),
                        F.array(*values).alias("f"))

    none = F.array().cast("array<struct<kind:string,start:int,end:int,f:array<double>>>")
    return F.concat(*(
        F.when(text.rlike(test), F.transform(spans_of(text, pattern), described(kind))).otherwise(none)
        for kind, pattern, test in GENERATORS))


PROPOSAL = "struct<kind:string,start:int,end:int,f:array<double>>"


def with_overlaps(proposed: Column, rules: dict[str, Column]) -> Column:
    """``array<struct<p, own, any>>``: each proposal, and whether it overlaps a rule's span of its own kind, and of any.

    One sweep over both lists by position: of the rules' spans that start before a proposal ends, the last end is compared with
    the proposal's start.
    """
    event = "struct<pos:int,turn:int,end:int,p:{}>".format(PROPOSAL)
    nothing = F.lit(None).cast(PROPOSAL)

    def starting(turn: int) -> Callable[[Column], Column]:
        return lambda s: F.struct(s["start"].alias("pos"), F.lit(turn).alias("turn"), s["end"].alias("end"), nothing.alias("p"))

    starts = [F.transform(spans, starting(turn)) for turn, spans in enumerate(rules.values(), 1)]
    ends = F.transform(proposed, lambda p: F.struct(p["end"].alias("pos"), F.lit(0).alias("turn"), p["start"].alias("end"), p.alias("p")))
    events = F.array_sort(F.concat(*(x.cast(f"array<{event}>") for x in (*starts, ends))))

    def step(last: Column, e: Column) -> tuple[Column, Column, Column]:
        now = F.struct(*(F.when(e["turn"] == turn + 1, F.greatest(last[k], e["end"])).otherwise(last[k]).alias(k)
                         for turn, k in enumerate(rules)))
        own = F.coalesce(*(F.when(e["p"]["kind"] == k, last[k] > e["end"]) for k in rules))
        value = F.struct(e["p"].alias("p"), own.alias("own"), (F.greatest(*(last[k] for k in rules)) > e["end"]).alias("any"))
        return now, value, e["turn"] == 0

    return gathered(events, F.struct(*(F.lit(-1).alias(k) for k in rules)), step, f"struct<p:{PROPOSAL},own:boolean,any:boolean>")


def with_rules(docs: DataFrame) -> DataFrame:
    """Add ``_text`` (null counts as empty) and the rules' spans as ``_email``, ``_ip``, ``_card`` and ``_phone``."""
    named = docs.withColumn("_text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    return named.select("*", *(rule_spans(F.col("_text"), k).alias(f"_{k}") for k in KINDS))


def fit_model(docs: DataFrame) -> tuple[boosting.Forest | None, dict[str, float]]:
    """Trees and the log-odds threshold of each kind.

    Trees are fitted on two thirds of at most MAX_PROPOSALS proposals from about SAMPLE_DOCS documents drawn by hash. Thresholds
    come from the last third and the proposals of all other documents, counted in Spark. A kind with fewer than 20 of these in
    the whole table is never accepted (threshold infinity); without both labels there are no trees.
    """
    total = max(docs.count(), 1)
    ring = 1 << 20
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(ring)) < int(ring * min(1.0, SAMPLE_DOCS / total))

    def labelled(part: DataFrame, *values: Callable[[Column], Column]) -> DataFrame:
        """A row for each proposal: kind, whether it lies on a rule's span of its kind, hash of its features, ``values``."""
        known = with_rules(part).withColumn("_all", with_overlaps(proposals(F.col("_text")), {k: F.col(f"_{k}") for k in KINDS}))
        on_rule = F.transform("_all", lambda x: F.struct(
            x["p"]["kind"].alias("kind"), x["own"].alias("label"), F.xxhash64(x["p"]["f"]).alias("place"), *(v(x["p"]) for v in values)))
        return known.select("drawn", F.explode(on_rule).alias("p")).select("drawn", "p.*")

    texts = docs.select("doc_id", "text", drawn.alias("drawn"))
    rows = labelled(texts.filter("drawn"), lambda p: p["f"].alias("f")).orderBy("place", "f", "label").limit(
        MAX_PROPOSALS).collect()
    limits = dict.fromkeys(KINDS, np.inf)
    features = np.array([r.f for r in rows], dtype=float).reshape(len(rows), len(FEATURES))
    label = np.array([r.label for r in rows], dtype=float)
    check = np.arange(len(rows)) % 3 == 2
    if len(rows) < 100 or label[~check].min() == label[~check].max():
        return None, limits
    forest = boosting.fit(features[~check], label[~check], trees=TREES, depth=DEPTH)

    def step(p: Column) -> Column:
        margin = forest.column([F.get(p["f"], F.lit(i)) for i in range(len(FEATURES))])
        return F.greatest(F.floor(margin * STEPS), F.lit(-1).cast("long")).alias("step")  # below even odds none is accepted

    counts: dict[str, dict[int, list[int]]] = {k: {} for k in KINDS}  # kind -> step -> proposals, of these right

    def count(kind: str, at: int, n: int, right: int) -> None:
        cell = counts[kind].setdefault(at, [0, 0])
        cell[0], cell[1] = cell[0] + n, cell[1] + right

    for margin, r in zip(forest.margin(features[check]), (r for r, held in zip(rows, check) if held)):
        count(r.kind, max(int(np.floor(margin * STEPS)), -1), 1, int(r.label))
    cut = len(rows) == MAX_PROPOSALS  # the draw may hold more
    if total > SAMPLE_DOCS or cut:
        unused = ~F.col("drawn") | (F.col("place") > rows[-1].place) if cut else ~F.col("drawn")
        others = labelled(texts if cut else texts.filter("not drawn"), step).filter(unused).groupBy("kind", "step").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("label").cast("long")).alias("right"))
        for r in others.collect():  # one row a step of a kind
            count(r.kind, r.step, r.n, r.right)
    for kind, steps in counts.items():
        if sum(n for n, _ in steps.values()) < 20:
            continue
        seen = right = 0
        for at in sorted(steps, reverse=True):
            seen, right = seen + steps[at][0], right + steps[at][1]
            if right >= PRECISION * seen:
                limits[kind] = max(at, 0) / STEPS  # never below even odds
    return forest, limits


def _listed(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def detect(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_rules`` and ``_spans``: sorted ``array<struct<start, place, end, kind>>`` in code points.

    ``_spans`` holds the rules' spans and accepted proposals. All columns of ``docs`` stay.
    """
    forest, limits = fit_model(docs)

    def tagged(column: Column, kind: str) -> Column:
        return F.transform(column, lambda s: F.struct(
            s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("place"), s["end"].alias("end"), F.lit(kind).alias("kind")))

    ruled = with_rules(docs).withColumn("_rules", F.array_sort(F.concat(*(tagged(F.col(f"_{k}"), k) for k in KINDS))))
    if forest is None or not np.isfinite(list(limits.values())).any():
        return ruled.withColumn("_spans", F.col("_rules"))

    def accepted(x: Column) -> Column:
        margin = forest.column([F.get(x["p"]["f"], F.lit(i)) for i in range(len(FEATURES))])
        limit = F.coalesce(*(F.when(x["p"]["kind"] == k, F.lit(float(v))) for k, v in limits.items()))
        return ~x["any"] & (margin >= limit)

    place = F.create_map(*(F.lit(x) for pair in zip(KINDS, range(len(KINDS))) for x in pair))
    beside = with_overlaps(proposals(F.col("_text")), {k: F.col(f"_{k}") for k in KINDS})
    added = F.transform(F.filter(beside, accepted), lambda x: F.struct(
        x["p"]["start"].alias("start"), place[x["p"]["kind"]].alias("place"), x["p"]["end"].alias("end"), x["p"]["kind"].alias("kind")))
    # All distinct: added ones overlap no rule's span, and those of one kind do not overlap each other.
    return ruled.withColumn("_spans", F.array_sort(F.concat(F.col("_rules"), added)))


def report(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)``, one row per document.

    Counts and ``base_sha256`` cover the rules, ``spans`` all redactions, each ``kind:start:end`` in code points. Null text counts
    as empty; repeated rows are reported each; other columns are ignored.
    """
    found = detect(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return found.select(
        "doc_id", *(F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(_listed(F.col("_rules")), 256).alias("base_sha256"), _listed(F.col("_spans")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in brackets, such as ``[EMAIL]``.

    Spans that overlap are replaced together under the kind of the first. A null text stays null; all columns stay.
    """
    found = detect(docs.select(packed(docs), "doc_id", "text"))
    cell = "struct<start:int,end:int,kind:string>"
    flush = F.array(F.struct(F.lit(2**31 - 1).alias("start"), F.lit(0).alias("end"), F.lit("").alias("kind"))).cast(f"array<{cell}>")
    spans = F.transform("_spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))

    def step(open_: Column, s: Column) -> tuple[Column, Column, Column]:
        inside = open_["end"] > s["start"]
        grown = F.struct(open_["start"].alias("start"), F.greatest(open_["end"], s["end"]).alias("end"), open_["kind"].alias("kind"))
        return F.when(inside, grown).otherwise(s), open_, ~inside & (open_["start"] >= 0)

    none = F.struct(F.lit(-1).alias("start"), F.lit(-1).alias("end"), F.lit("").alias("kind")).cast(cell)
    merged = gathered(F.concat(spans.cast(f"array<{cell}>"), flush), none, step, cell)
    # A substring is found from the start of its text, so texts are cut into cells first and pieces looked up in these.
    cells = F.transform(F.sequence(F.lit(0), F.length("_text").cast("int"), F.lit(CELL)), lambda at: F.substr(F.col("_text"), at + 1, F.lit(CELL)))

    def piece(start: Column, end: Column) -> Column:
        first, last = F.floor(start / CELL).cast("int"), F.floor(end / CELL).cast("int")
        return F.substr(F.array_join(F.slice("_cells", first + 1, last - first + 1), ""), start % CELL + 1, end - start)

    previous = lambda i: F.when(i > 0, F.get("_merged", i - 1)["end"]).otherwise(0)
    pieces = F.transform("_merged", lambda s, i: F.concat(piece(previous(i), s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]")))
    rest = piece(F.element_at("_merged", -1)["end"], F.length("_text").cast("int"))
    clean = F.when(F.size("_merged") > 0, F.concat(F.array_join(pieces, ""), rest)).otherwise(F.col("text"))
    return found.withColumn("_merged", merged).withColumn("_cells", F.when(F.size("_merged") > 0, cells)).select(*unpacked(docs, text=clean))
