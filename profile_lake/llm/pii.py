"""Personal data in texts, with DataFrame functions only.

Regular expressions propose spans, validators confirm them (Luhn for cards, mod-97 for
bank accounts, ranges of numbers for addresses and telephone numbers), and words before
a span adjust its score. The text is split at a kind's matches; the lengths of the gaps
and matches, summed up in order, give the places. Candidates of all kinds become rows,
which are few; one shuffle by row brings a document's own together.

The patterns use possessive repeats and look-behinds where these match the same: long
runs are then passed in one step and never need a deep stack.

Null text: empty. Repeated rows: each gets its result. Overlapping spans of different
kinds all stay. Empty table: empty result. Other columns and their names do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Characters before a span that are searched for context words.
CONTEXT = 40
#: Spans that only the method proposes need this score.
MIN_SCORE = 0.5


@dataclass(frozen=True)
class Kind:
    """``pattern`` is tried only on texts that match ``guard``."""

    name: str
    pattern: str
    guard: str
    context: str
    score: float
    base: bool = True


# Equal in matches to: email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+, ip four runs of
# digits joined by dots, card [0-9]([\x20-]?[0-9])+ with 14 digits or more, phone
# \+[0-9][\x20().0-9-]+[0-9].
KINDS = [
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        r"mail|contact|write|address|kontakt|correo|courriel",
        0.8,
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        r"[0-9]\.[0-9]",
        r"\bip\b|host|server|address|addr",
        0.6,
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9]){13,}+",
        r"[0-9][\x20-]?[0-9][\x20-]?[0-9]",
        r"card|visa|credit|karte|tarjeta|carte|payment",
        0.7,
    ),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", r"phone|tel|call|mobile|fax|anruf|llama", 0.6),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        r"[A-Z]{2}[0-9]{2}[\x20A-Z0-9]",
        r"iban|bank|account|konto|cuenta|compte",
        0.7,
        base=False,
    ),
]

_CANDIDATE = "struct<kind:int,at:int,gap:int,size:int,hit:string,before:string>"


def _candidates(text: Column, number: int, kind: Kind) -> Column:
    """What the pattern matches, in order, each with the text between it and the one before."""
    zipped = F.arrays_zip(
        F.split(text, kind.pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("hit"),
    )
    made = F.transform(
        zipped,
        lambda z, i: F.struct(
            F.lit(number).alias("kind"),
            i.alias("at"),
            F.length(z["gap"]).alias("gap"),
            F.length(z["hit"]).alias("size"),
            z["hit"].alias("hit"),
            F.right(z["gap"], F.lit(CONTEXT)).alias("before"),
        ),
    )
    guard = F.contains(text, F.lit(kind.guard)) if len(kind.guard) == 1 else text.rlike(kind.guard)
    return F.coalesce(F.when(guard, made), F.array()).cast(f"array<{_CANDIDATE}>")


def _mod97(account: Column) -> Column:
    """Remainder of the account number with its first four signs last and letters as 10 to 35."""
    signs = F.split(F.concat(F.substring(account, 5, 40), F.substring(account, 1, 4)), "")
    return F.aggregate(
        F.filter(signs, lambda c: c != ""),
        F.lit(0),
        lambda acc, c: F.when(F.ascii(c) < 58, acc * 10 + F.ascii(c) - 48).otherwise(acc * 100 + F.ascii(c) - 55) % 97,
    )


def _confirmed(kind: Column, hit: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]", "")
    plain = F.regexp_replace(hit, " ", "")
    tests = {
        "email": F.lit(True),
        "ip": hit.rlike(r"^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}"),
        "card": F.length(digits).between(14, 19) & F.call_function("luhn_check", digits),
        "phone": F.length(digits).between(10, 15),
        "iban": F.length(plain).between(15, 34) & (_mod97(plain) == 1),
    }
    out = F.lit(False)
    for number, k in enumerate(KINDS):
        out = F.when(kind == number, tests[k.name]).otherwise(out)
    return out


def _score(kind: Column, before: Column) -> Column:
    """A kind's own score; a context word before the span takes half the way to 1."""
    out = F.lit(0.0)
    for number, k in enumerate(KINDS):
        near = F.lower(before).rlike(k.context)
        out = F.when(kind == number, F.when(near, (1 + k.score) / 2).otherwise(k.score)).otherwise(out)
    return out


def find(docs: DataFrame, keep: list[Column] | None = None) -> DataFrame:
    """The kept columns (doc_id) and the spans of every document.

    Spans are {start, kind, end, score}: kind by its place in :data:`KINDS`, places in
    code points, end exclusive; sorted by start, then kind.
    """
    keep = keep or [F.col("doc_id").cast("long").alias("doc_id")]
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.struct(*keep).alias("kept"), F.coalesce("text", F.lit("")).alias("text")
    )
    document = F.struct(
        F.lit(-1).alias("kind"), F.lit(0).alias("at"), F.lit(0).alias("gap"), F.lit(0).alias("size"),
        F.lit(None).cast("string").alias("hit"), F.lit(None).cast("string").alias("before"),
    )
    proposed = F.concat(
        F.array(document).cast(f"array<{_CANDIDATE}>"),
        *[_candidates(F.col("text"), number, kind) for number, kind in enumerate(KINDS)],
    )
    by_kind = W.partitionBy("row", "kind").orderBy("at").rowsBetween(W.unboundedPreceding, W.currentRow)
    own = F.array([F.lit(k.base) for k in KINDS])
    candidates = (
        rows.select("row", "kept", F.explode(proposed).alias("c"))
        .select("row", "c.*", F.when(F.col("c.kind") < 0, F.col("kept")).alias("kept"))
        .filter((F.col("kind") < 0) | F.col("hit").isNotNull())
        .repartition("row")
        .withColumn("end", F.sum(F.col("gap") + F.col("size")).over(by_kind))
        .withColumn("score", _score(F.col("kind"), F.col("before")))
        .withColumn("good", _confirmed(F.col("kind"), F.col("hit")))
    )
    span = F.struct(
        (F.col("end") - F.col("size")).cast("long").alias("start"), "kind", F.col("end").cast("long").alias("end"), "score"
    )
    wanted = F.col("good") & (F.element_at(own, F.col("kind") + 1) | (F.col("score") >= MIN_SCORE))
    return (
        candidates.groupBy("row")
        .agg(
            F.first("kept", ignorenulls=True).alias("kept"),
            F.array_sort(F.collect_list(F.when((F.col("kind") >= 0) & wanted, span))).alias("spans"),
        )
        .select("kept.*", "spans")
    )


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array([F.lit(k.name) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def redacted(docs: DataFrame) -> DataFrame:
    """All rows of ``docs``; in `text` every span is replaced by its kind in brackets.

    Spans that overlap are replaced together, under the first one's kind. Other columns
    pass unchanged.
    """
    found = find(docs, [F.struct("*").alias("row_columns")])
    names = F.array([F.lit(f"[{k.name.upper()}]") for k in KINDS])
    text = F.col("row_columns.text")
    nothing = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("reach"))
    rebuilt = F.aggregate(
        "spans",
        nothing,
        lambda acc, s: F.struct(
            F.when(
                s["start"] >= acc["reach"],
                F.concat(
                    acc["done"],
                    F.substring(text, (acc["reach"] + 1).cast("int"), (s["start"] - acc["reach"]).cast("int")),
                    F.element_at(names, s["kind"] + 1),
                ),
            )
            .otherwise(acc["done"])
            .alias("done"),
            F.greatest(acc["reach"], s["end"]).alias("reach"),
        ),
        lambda acc: F.concat(acc["done"], F.substring(text, (acc["reach"] + 1).cast("int"), F.length(text))),
    )
    changed = F.when(F.size("spans") > 0, rebuilt).otherwise(text).alias("text")
    return found.select(*[changed if c == "text" else F.col("row_columns")[c].alias(c) for c in docs.columns])
