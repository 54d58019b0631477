"""Personal data by weak supervision, in DataFrame expressions only.

Base spans come from four fixed patterns and their checks. Beyond them, wider patterns
propose *candidates* of the same kinds: addresses written out ("x [at] y [dot] com"),
numbers that a base pattern runs together with what follows, numbers in national form,
longer network addresses. Then:

1. Labelers vote on every base span and candidate, 1 for personal data, -1 against, 0
   without an opinion: the form (regular expressions), numbers and checksums, gazetteers
   (domain endings, issuers, calling codes, network prefixes), words before it that
   speak for its kind, and words and characters around it that speak against it.
2. Expectation-maximisation over the table of vote patterns, which has at most 3 to the
   power of five rows for each kind, estimates how common personal data is and how
   reliable each labeler is in either class: a fold over that table in one expression per
   kind, of which the driver sees the weights, 16 numbers.
3. The posteriors are soft labels from which the span classifier is trained: naive Bayes
   over the votes, the candidate's shape and the words around it, hashed into
   ``BUCKETS``. Its weights are one aggregate, a list of fixed length.
4. Candidates that the classifier gives ``ACCEPT`` or more are spans; base spans always
   are, and a candidate that overlaps a base span of its kind never is.

Places: a text split by a pattern and what the pattern extracts alternate, so places are
running sums of lengths, in two levels, so that texts with very many matches do not cost
their square. Repeats in the patterns are possessive, or bounded by a character that
starts them, and are tried once per run of characters: long texts without white
space cost their length. Texts are read once, by a map; only spans are shuffled.
"""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthfold.llm.common import own, whole_text, written

KINDS = ("email", "ip", "card", "phone")
ACCEPT = 0.9
ROUNDS = 12
BUCKETS = 512
CHUNK = 256
BEFORE, AFTER = 40, 24

# The four base patterns. A match may start where the last one ended, or
# else only where a run of its characters starts, which is where the leftmost one does.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT = r"(?:\x20?[\[({<]\x20?(?:at|AT|@)\x20?[\])}>]\x20?|\x20(?:at|AT|@)\x20|@)"
_DOT = r"(?:\x20?[\[({<]\x20?(?:dot|DOT|\.)\x20?[\])}>]\x20?|\x20(?:dot|DOT)\x20|\.)"
_GROUP = r"[\x20./-]?"
WIDE = {
    "email": rf"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++",
    "ip": (
        r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:])"
        r"|(?<![0-9])[0-9]{1,3}(?:\x20?[\[(]\x20?(?:\.|dot|DOT)\x20?[\])]\x20?[0-9]{1,3}){3}(?![0-9])"
    ),
    "card": (
        r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[\x20./-][0-9]{4}){3}|[0-9]{4}[\x20./-][0-9]{6}[\x20./-][0-9]{5})(?![0-9])"
    ),
    "phone": (
        rf"\+[1-9][0-9]{{0,2}}{_GROUP}\(?[0-9]{{2,4}}\)?{_GROUP}[0-9]{{3,4}}{_GROUP}[0-9]{{3,4}}(?![0-9])"
        rf"|(?<![0-9+.])00[1-9][0-9]{{0,2}}{_GROUP}\(?[0-9]{{2,4}}\)?{_GROUP}[0-9]{{3,4}}{_GROUP}[0-9]{{3,4}}(?![0-9])"
        r"|(?<![0-9+.])(?:\([0-9]{3,5}\)\x20?|[0-9]{3,5}[\x20./-])[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])"
    ),
}
# Parts of texts without which a pattern cannot match; texts without them are not searched.
NEEDS = {
    "email": ["@"],
    "ip": ["."],
    "card": [],
    "phone": ["+"],
}
WIDE_NEEDS = {
    "email": ["dot", "DOT", "(at", "[at", "{at", "<at", "( at", "[ at", "(AT", "[AT", "(@", "[@", " @ "],
    "ip": [":", "[.", "(.", "dot", "DOT"],
    "card": [],
    "phone": [],
}
# Gazetteers and context words of the labelers.
ENDINGS = "com org net edu gov mil int info io co eu uk de fr es it nl ch at be pl pt us ca au".split()
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)"
CALLING = r"^(?:\+|00)(?:1|7|20|27|3[0-469]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
SPEAKS_FOR = {
    "email": r"mail|contact|write|reach|kontakt|correo|adresse|address|escri|écri",
    "ip": r"\bip\b|ipv[46]|host|server|address|adresse|client|dirección|from",
    "card": r"card|visa|master|amex|credit|debit|karte|carte|tarjeta|payment|zahl",
    "phone": r"phone|\btel|call|mobile|cell|fax|contact|telefon|anruf|móvil|llam|appel|portable|whatsapp|sms",
}
SPEAKS_AGAINST = (
    r"(?:order|invoice|version|isbn|issn|serial|ref|\bid|\bno|\bnr|key|token|password|secret|hash|sha|page|line|figure|"
    r"rechnung|bestell\w*|commande|facture|pedido|factura)[\x20:#=.\"'-]*$"
)
LABELERS = 5


def matched(text: Column, pattern: str) -> Column:
    """Alternating gaps and matches: array of (unit, before, head, match), the last without a match.

    ``unit``: code points of the gap and its match; ``before``: the gap's end; ``head``: its start.
    """
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.zip_with(
        gaps,
        found,
        lambda gap, match: F.struct(
            (F.length(gap) + F.coalesce(F.length(match), F.lit(0))).cast("long").alias("unit"),
            F.right(gap, F.lit(BEFORE)).alias("before"),
            F.left(gap, F.lit(AFTER)).alias("head"),
            match.alias("match"),
        ),
    )


def searched(docs: DataFrame) -> DataFrame:
    """One row per document: a number of its own, and what each pattern matched (null where it cannot)."""
    text = F.col("body")
    rows = own(docs, "doc_id", "text").select("doc_id", whole_text().alias("body"))
    digits = F.col("digits")

    def when(kind: str, pattern: str, needs: list[str]) -> Column:
        there = reduce(or_, [F.contains(text, F.lit(part)) for part in needs], F.lit(False)) if needs else F.lit(True)
        return F.when(there if kind == "email" else there & digits, matched(text, pattern))

    marked = rows.withColumn("digits", text.rlike("[0-9]"))
    # Hexadecimal addresses may have no digit.
    wide_ip = reduce(or_, [F.contains(text, F.lit(part)) for part in WIDE_NEEDS["ip"]])
    return marked.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        *[when(kind, BASE[kind], NEEDS[kind]).alias(f"base_{kind}") for kind in KINDS],
        *[
            (F.when(wide_ip, matched(text, WIDE[kind])) if kind == "ip" else when(kind, WIDE[kind], WIDE_NEEDS[kind])).alias(f"wide_{kind}")
            for kind in KINDS
        ],
    )


def located(name: str) -> Column:
    """The matches of a column of ``searched``: array of (start, end, match, before, after), end exclusive."""
    units = F.col(name)
    none = F.array().cast("array<struct<start:bigint,end:bigint,match:string,before:string>>")
    chunks = F.sequence(F.lit(0), F.floor((F.size(units) - 1) / CHUNK).cast("int"))

    def part(number: Column) -> Column:
        return F.slice(units, number * CHUNK + 1, F.lit(CHUNK))

    starts = F.aggregate(
        chunks,
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("out")),
        lambda a, c: F.struct(
            F.aggregate(part(c), a["at"], lambda s, x: s + x["unit"]).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")
        ),
        lambda a: a["out"],
    )
    placed = F.flatten(
        F.zip_with(
            chunks,
            starts,
            lambda c, start: F.aggregate(
                part(c),
                F.struct(start.alias("at"), none.alias("out")),
                lambda a, x: F.struct(
                    (a["at"] + x["unit"]).alias("at"),
                    F.concat(
                        a["out"],
                        F.array(
                            F.struct(
                                (a["at"] + x["unit"] - F.length(x["match"])).alias("start"),
                                (a["at"] + x["unit"]).alias("end"),
                                x["match"].alias("match"),
                                x["before"].alias("before"),
                            )
                        ),
                    ).alias("out"),
                ),
                lambda a: a["out"],
            ),
        )
    )
    following = F.zip_with(
        placed,
        F.slice(units, F.lit(2), F.greatest(F.size(units), F.lit(1))),
        lambda x, y: F.struct(x["start"], x["end"], x["match"], x["before"], y["head"].alias("after")),
    )
    some = F.filter(following, lambda x: x["match"].isNotNull())
    return F.when(F.size(units) > 1, some).otherwise(F.array().cast("array<struct<start:bigint,end:bigint,match:string,before:string,after:string>>"))


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits, 1 to 19 long, passes the checksum; false for others."""
    size = F.length(digits)

    def worth(i: Column) -> Column:
        digit = F.substring(digits, size - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, digit).otherwise(2 * digit - F.when(digit > 4, 9).otherwise(0))

    total = F.aggregate(F.sequence(F.lit(0), size - 1), F.lit(0), lambda s, i: s + worth(i))
    return F.when(size.between(1, 19), total % 10 == 0).otherwise(False)


_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"


def sound(kind: str, match: Column) -> Column:
    """The check of a base pattern's match."""
    if kind == "ip":
        return match.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        digits = F.regexp_replace(match, r"[\x20-]", "")
        return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits_of(match)).between(10, 15)
    return F.lit(True)


def base_spans(found: DataFrame) -> DataFrame:
    """row, doc_id, and the sound matches of each base pattern."""

    def checked(kind: str) -> Column:
        return F.filter(located(f"base_{kind}"), lambda x: sound(kind, x["match"])).alias(kind)

    return found.select("row", "doc_id", *[checked(kind) for kind in KINDS])


def candidates(found: DataFrame) -> DataFrame:
    """A row per base span and per wider match that overlaps no base span of its kind."""
    spans = None
    for number, kind in enumerate(KINDS):
        for name, is_base in ((f"base_{kind}", True), (f"wide_{kind}", False)):
            listed = found.where(F.size(name) > 1).select("row", F.explode(located(name)).alias("s"))
            if is_base:
                listed = listed.where(sound(kind, F.col("s.match")))
            listed = listed.select("row", F.lit(number).alias("kind"), F.lit(is_base).alias("base"), "s.*")
            spans = listed if spans is None else spans.unionByName(listed)
    order = Window.partitionBy("row", "kind").orderBy("start", "end", "base")
    ends, starts = F.when(F.col("base"), F.col("end")), F.when(F.col("base"), F.col("start"))
    met = spans.select(
        "*",
        F.max(ends).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("_end"),
        F.lead(starts, 1).over(order).alias("_start"),
    )
    # Base spans of a kind do not overlap each other, nor do wider ones: the next row is the one to look at.
    clear = (F.coalesce("_end", F.lit(-1)) <= F.col("start")) & (F.coalesce("_start", F.col("end")) >= F.col("end"))
    return met.where(F.col("base") | clear).drop("_end", "_start")


def choose(options: list[Column]) -> Column:
    """The option of the row's kind."""
    chosen = F.when(F.col("kind") == 0, options[0])
    for number, option in enumerate(options[1:], 1):
        chosen = chosen.when(F.col("kind") == number, option)
    return chosen


def vote(good: Column, bad: Column) -> Column:
    return F.when(good, 1).when(bad, -1).otherwise(0)


def votes(spans: DataFrame) -> DataFrame:
    """The spans with the labelers' votes v0 to v4."""
    match, before, after = F.col("match"), F.lower("before"), F.col("after")
    digits, base = digits_of(match), F.col("base")
    count = F.length(digits)
    six = match.contains(":")
    ending = F.lower(F.regexp_extract(match, "([A-Za-z0-9-]+)$", 1))
    plain_ip = match.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$")
    parts = F.regexp_replace(match, r"[^0-9]+", ".").rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    groups = F.size(F.split(match, ":"))
    hexadecimal = match.rlike("[A-Fa-f]") & (groups >= 4)
    no = F.lit(False)
    form = choose(
        [
            vote(base | match.rlike(r"[\[({<]"), no),
            vote(plain_ip | (six & (groups == 8)), six & (groups < 4) | ~six & ~plain_ip & ~match.rlike(r"[\[(]")),
            vote(match.rlike(r"^[0-9]{15,16}$|^[0-9]{4}(?:[\x20-][0-9]{4}){3}$"), count < 14),
            vote(match.rlike(r"^\+|\("), match.rlike("^[0-9]+$")),
        ]
    )
    number = choose(
        [
            vote(ending.rlike("^[a-z]{2,6}$"), ~ending.rlike("^[a-z]{2,6}$")),
            vote(F.when(six, hexadecimal).otherwise(parts), F.when(six, ~hexadecimal).otherwise(~parts)),
            vote(luhn(digits), ~luhn(digits)),
            vote(count.between(10, 15), ~count.between(10, 15)),
        ]
    )
    reachable = match.rlike(r"^\(?[2-9][0-9]{2}\)?[^0-9]?[2-9][0-9]{2}[^0-9]?[0-9]{4}$")
    listed = choose(
        [
            vote(ending.isin(ENDINGS), ~ending.isin(ENDINGS)),
            vote(match.rlike("^(?:[23][0-9A-Fa-f]{3}|[fF][eE]80|[fF][cCdD][0-9A-Fa-f]{2}):"), six | match.rlike("^(?:0|2[4-9][0-9])[.]")),
            vote(digits.rlike(ISSUERS), ~digits.rlike(ISSUERS)),
            vote(match.rlike(CALLING) | reachable, match.rlike("^(?:[+]|00)")),
        ]
    )
    speaks = choose([vote(before.rlike(SPEAKS_FOR[kind]), no) for kind in KINDS])
    attached = F.col("before").rlike(r"[\p{L}\p{N}=/_&#$-]$") | after.rlike(r"^[\p{L}\p{N}=/_]")
    against = vote(no, before.rlike(SPEAKS_AGAINST) | attached)
    return spans.withColumns({f"v{i}": v for i, v in enumerate((form, number, listed, speaks, against))})


def features(spans: DataFrame) -> DataFrame:
    """The spans with the buckets of their shape and of the words around them."""
    shape = F.regexp_replace(F.regexp_replace("match", "[0-9]", "9"), r"\p{L}+", "a")
    last = F.lower(F.regexp_extract("before", r"([^\x20\x09-\x0D]*)[\x20\x09-\x0D]*$", 1))
    first = F.lower(F.regexp_extract("after", r"^[\x20\x09-\x0D]*([^\x20\x09-\x0D]*)", 1))
    spread = [F.pmod(F.xxhash64(x), F.lit(BUCKETS)).cast("int") for x in (shape, last, first)]
    return spans.withColumns({f"f{i}": f for i, f in enumerate(spread)})


def vote_score(weights: list[float]) -> Column:
    """Log odds by ``weights``: per kind a prior, then three values for each labeler."""
    table = F.lit([float(w) for w in weights])
    row = 1 + 3 * LABELERS
    at = [F.col("kind") * row] + [F.col("kind") * row + 1 + 3 * i + F.col(f"v{i}") + 1 for i in range(LABELERS)]
    return reduce(add, [F.get(table, a.cast("int")) for a in at])


def chance(odds: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.least(odds, F.lit(30.0)), F.lit(-30.0))))


# What is assumed of a labeler before it is seen: votes of -1, 0 and 1 in either class.
PRIOR = {1: (0.5, 1.0, 2.0), 0: (2.0, 1.0, 0.5)}


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def reliabilities(patterns: DataFrame, rounds: int = ROUNDS) -> list[float]:
    """Weights for ``vote_score`` by expectation-maximisation over (kind, v0.., n) rows.

    A fold over the rounds inside one expression per kind. It starts from the assumed votes;
    each round weighs the patterns by the last weights and estimates anew, with
    the assumed votes as further observations. Kinds without patterns keep those.
    """
    cells = [(i, v) for i in range(LABELERS) for v in range(3)]
    zeros = F.lit([0.0] * (2 + 2 * len(cells)))

    def sums(weights: Column) -> Column:
        """Mass for and against, then of each labeler's votes."""

        def weighed(p: Column) -> Column:
            odds = [F.get(weights, F.lit(0))] + [F.get(weights, 2 + 3 * i + F.get(p["v"], F.lit(i))) for i in range(LABELERS)]
            post = chance(reduce(add, odds))
            return F.struct(p["v"].alias("v"), (p["n"] * post).alias("yes"), (p["n"] * (1 - post)).alias("no"))

        def shares(x: Column) -> Column:
            parts = [F.when(F.get(x["v"], F.lit(i)) == v - 1, x[c]).otherwise(0.0) for c in ("yes", "no") for i, v in cells]
            return F.array(x["yes"], x["no"], *parts)

        return F.aggregate(
            F.transform("patterns", weighed), zeros, lambda total, x: F.zip_with(total, shares(x), lambda left, right: left + right)
        )

    def estimated(s: Column) -> Column:
        mass = {1: F.get(s, F.lit(0)), 0: F.get(s, F.lit(1))}
        share = {
            (z, c): (F.get(s, F.lit(2 + c + (0 if z else len(cells)))) + PRIOR[z][v]) / (mass[z] + sum(PRIOR[z]))
            for z in (0, 1)
            for c, (_, v) in enumerate(cells)
        }
        return F.array(F.log((mass[1] + 1) / (mass[0] + 1)), *[F.log(share[1, c] / share[0, c]) for c in range(len(cells))])

    start = estimated(zeros)
    fold = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, lambda w, _: bound(sums(w), estimated))
    listed = F.collect_list(F.struct(F.array(*[f"v{i}" for i in range(LABELERS)]).alias("v"), "n"))
    kinds = patterns.sparkSession.range(len(KINDS)).select(F.col("id").cast("int").alias("kind"))
    none = F.array().cast("array<struct<v:array<int>,n:bigint>>")
    table = kinds.join(patterns.groupBy("kind").agg(F.sort_array(listed).alias("some")), "kind", "left")
    found = table.select("kind", F.coalesce("some", none).alias("patterns")).select("kind", fold.alias("w"))
    return [w for r in sorted(found.collect(), key=lambda r: r.kind) for w in r.w]


def trained(spans: DataFrame, weights: list[float]) -> Column:
    """The classifier's log odds for (kind, v0.., f0..): votes, and what shapes and words add.

    Buckets are weighed by soft counts, one more in each class for every bucket; the list
    has an entry for each kind, feature and bucket, whatever the number of spans.
    """
    post = spans.withColumn("post", chance(vote_score(weights)))
    per_kind = 3 * BUCKETS
    entry = [F.struct((F.col("kind") * per_kind + i * BUCKETS + F.col(f"f{i}")).alias("at")) for i in range(3)]
    counted = (
        post.select(F.explode(F.array(*entry)).alias("e"), "post")
        .groupBy(F.col("e.at").alias("at"))
        .agg(F.sum("post").alias("for"), F.sum(1 - F.col("post")).alias("against"))
    )
    blocks = Window.partitionBy(F.floor(F.col("at") / BUCKETS))
    filled = post.sparkSession.range(len(KINDS) * per_kind).select(F.col("id").alias("at")).join(counted, "at", "left").select(
        "at", F.coalesce("for", F.lit(0.0)).alias("for"), F.coalesce("against", F.lit(0.0)).alias("against")
    )
    share = [(F.col(c) + 1) / (F.sum(c).over(blocks) + BUCKETS) for c in ("for", "against")]
    weighed = filled.select("at", F.log(share[0] / share[1]).alias("w"))
    table = weighed.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "w"))), lambda x: x["w"]).alias("w"))
    model = table.scalar()
    extra = [F.get(model, (F.col("kind") * per_kind + i * BUCKETS + F.col(f"f{i}")).cast("int")) for i in range(3)]
    return vote_score(weights) + reduce(add, extra)


def private_spans(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): ``base`` and ``spans``, arrays of (start, kind, end).

    Places are code points, ends exclusive; ``kind`` is the place in ``KINDS``; arrays are
    in that order. ``base`` holds the matches of the base patterns that pass their
    checks, ``spans`` also the accepted candidates. Null texts are empty; rows with equal or null
    doc_ids are rows of their own; other columns are not looked at; an empty table gives no rows.
    """
    found = written(searched(docs), "matches")
    spans = written(features(votes(candidates(found))), "spans")
    named = [f"v{i}" for i in range(LABELERS)]
    patterns = written(spans.groupBy("kind", *named).agg(F.count(F.lit(1)).alias("n")), "patterns")
    odds = trained(spans, reliabilities(patterns))
    accepted = spans.where(~F.col("base")).withColumn("odds", odds).where(chance(F.col("odds")) >= ACCEPT)
    added = accepted.groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("added"))

    def listed(number: int) -> Column:
        return F.transform(KINDS[number], lambda x: F.struct(x["start"].alias("start"), F.lit(number).alias("kind"), x["end"].alias("end")))

    based = base_spans(found).select("row", "doc_id", F.array_sort(F.concat(*[listed(i) for i in range(len(KINDS))])).alias("base"))
    joined = based.join(added, "row", "left")
    whole = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))))
    return joined.select("doc_id", "base", F.when(F.col("added").isNull(), F.col("base")).otherwise(whole).alias("spans"))


def shown(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.lit(list(KINDS))
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ","
    )
