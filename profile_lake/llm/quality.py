"""Quality rules, judged per document and per host.

Every document is measured alone. Rule failures are then counted by host, each
host's failure rate is shrunk towards all hosts by a beta prior fitted to the hosts'
own rates, and the host's verdict is joined back to its documents.

Null or empty text: no words, so the document fails. Null host: such documents are
judged on their own, no host verdict applies. Repeated rows: each is measured and
counted. Empty table: empty result. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profile_lake.llm.batches import BASES, SPACE_BYTES, Rolling, Words, byte_table, covered, map_texts
from profile_lake.llm.batches import per_text, spans, window_starts
from profile_lake.session import stage

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: A host is rejected when its shrunken rate of failing documents exceeds this.
MAX_HOST_RATE = 0.5

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _repeats(lanes: list[np.ndarray], text_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which names (both lanes) occur more than once in their text, and which occurred earlier."""
    order = np.lexsort((*lanes, text_of))
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = True
    for key in (*lanes, text_of):
        same[1:-1] &= key[order][1:] == key[order][:-1]
    again, often = np.zeros(len(order), bool), np.zeros(len(order), bool)
    again[order] = same[:-1]
    often[order] = same[:-1] | same[1:]
    return often, again


def measure(part: pa.RecordBatch) -> list[np.ndarray]:
    """The columns of :data:`MEASURES` for a slice of texts."""
    words = Words(part.column("text"), SPACE_BYTES)
    data, begin = words.data, words.begin
    n_words, n = words.counts, int(words.first[-1])
    word_chars = per_text(words.inside & ((data & 0xC0) != 0x80), begin)
    n_symbols = per_text(byte_table(SYMBOLS)[data], begin)

    lanes = [Rolling(data, base) for base in BASES]
    line_starts, line_ends = spans(data != 0x0A, begin)
    before = np.searchsorted(words.starts, line_starts)
    with_word = np.searchsorted(words.starts, line_ends) > before
    line_starts, line_ends = line_starts[with_word], line_ends[with_word]
    line_text = np.searchsorted(begin, line_starts, "right") - 1
    _, again = _repeats([lane.of(line_starts, line_ends) for lane in lanes], line_text)
    n_dup_lines = np.bincount(line_text[again], minlength=len(n_words))

    starts = window_starts(words.first, WINDOW)
    names = [
        Rolling(lane.of(words.starts, words.ends), base).of(starts, starts + WINDOW) for lane, base in zip(lanes, BASES)
    ]
    often, _ = _repeats(names, words.text_of[starts])
    n_repeat = per_text(covered(starts[often], WINDOW, n), words.first)
    return [n_words, word_chars, n_symbols, n_dup_lines, n_repeat]


def measured(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host and :data:`MEASURES` of every document."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        columns = [pa.array(x.astype(np.int64)) for x in measure(part)]
        names = [x.split()[0] for x in MEASURES.split(", ")]
        return pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], ["doc_id", "host", *names])

    narrow = docs.select(F.col("doc_id").cast("long"), F.col(host).cast("string").alias("host"), "text")
    return map_texts(narrow, work, f"doc_id long, host string, {MEASURES}")


def rules() -> dict[str, Column]:
    """Each rule is true where a document breaks it."""
    return {
        "few_words": F.col("n_words") < MIN_WORDS,
        "repeated": F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT,
    }


@dataclass(frozen=True)
class BetaPrior:
    """Prior of a host's failure rate: pseudo-counts of failing and passing documents."""

    failing: float
    passing: float

    @classmethod
    def fitted(cls, mean: float | None, variance: float | None) -> BetaPrior:
        """By the moments of the hosts' rates.

        Hosts that all agree (no variance) count as much as ten thousand documents each;
        rates scattered to the ends count as one.
        """
        mean = 0.0 if mean is None else mean
        weight = mean * (1 - mean) / variance - 1 if variance else 1e4
        weight = min(max(weight, 1.0), 1e4)
        return cls(mean * weight, (1 - mean) * weight)


def host_rates(flagged: DataFrame) -> DataFrame:
    """Documents and failures by rule of each non-null host."""
    counts = [F.sum(F.col(f"broke_{name}").cast("long")).alias(f"broke_{name}") for name in rules()]
    return flagged.filter(F.col("host").isNotNull()).groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"), *counts)


def rejected_hosts(rates: DataFrame) -> DataFrame:
    """Hosts of which some rule's shrunken failure rate is beyond :data:`MAX_HOST_RATE`."""
    names = list(rules())
    moments = rates.agg(
        *[F.avg(F.col(f"broke_{n}") / F.col("n_docs")).alias(f"mean_{n}") for n in names],
        *[F.var_pop(F.col(f"broke_{n}") / F.col("n_docs")).alias(f"var_{n}") for n in names],
    ).first()  # one row of numbers
    bad = F.lit(False)
    for name in names:
        prior = BetaPrior.fitted(moments[f"mean_{name}"], moments[f"var_{name}"])
        shrunk = (F.col(f"broke_{name}") + prior.failing) / (F.col("n_docs") + prior.failing + prior.passing)
        bad = bad | (shrunk > MAX_HOST_RATE)
    return rates.filter(bad).select("host", F.lit(True).alias("host_rejected"))


def judge(docs: DataFrame, host: str = "source") -> DataFrame:
    """Measures of every document, the rules it breaks, and its verdict `kept`.

    Measures and host counts are staged: texts are read once, and the hosts' table is
    broadcast only if its written size is below Spark's threshold.
    """
    flags = {f"broke_{name}": F.coalesce(rule, F.lit(False)) for name, rule in rules().items()}
    flagged = stage(measured(docs, host).withColumns(flags), "quality")
    rates = stage(host_rates(flagged), "hosts")
    rejected = stage(rejected_hosts(rates), "rejected-hosts")
    failed = F.lit(False)
    for name in flags:
        failed = failed | F.col(name)
    return (
        flagged.join(rejected, "host", "left")
        .withColumn("base_failed", failed)
        .withColumn("host_rejected", F.coalesce("host_rejected", F.lit(False)))
        .withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
    )
