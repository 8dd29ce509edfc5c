"""Document fingerprints from closed syncmers, in column expressions only.

A run of ``K`` words is a closed syncmer if the smallest hash among its words is that of the first
or the last of them.  Whether it is one depends on its own words alone, so an edit elsewhere in the text
neither adds nor removes it.  The fingerprint has all syncmers in text order, each with the step from the one before
it, and two texts are compared by these: what the likeness counts can be read off the two fingerprints.

That the anchors are free of context also saves work: those of the edited text are those of the text wholly before the
edit, and only the seam and what follows is looked at again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm.common import WORD
from textmill.operators.ordered import with_position

K = 4
#: An anchor is a step (4 bits) and as many bits of the hash of its words.
HASH_BITS = 28
#: In place of the step where the whole text is the anchor, as it has fewer than ``K`` words.
WHOLE = 7
BLANK = r"[\x20\x09-\x0D]"
#: The run of word characters at the end of a text.
LAST_RUN = rf"(?s)^(?:.*{BLANK})?([^\x20\x09-\x0D]*)$"
_KEY = ["did", "unnamed", "hashed"]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def word_hashes(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))


def syncmer_places(units: Column) -> Column:
    """Where the closed syncmers of an array of hashed words begin.

    No two neighbours are further apart than ``K - 1``, nor the first from the start.
    """
    # no place at all where the array is too short for one
    last = F.size(units) - K
    every = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    return F.filter(
        every, lambda i: F.least(*[units[i + j] for j in range(K)]) == F.least(units[i], units[i + (K - 1)])
    )


def _code(step: Column, hashed: Column) -> Column:
    return F.shiftleft(step, HASH_BITS).bitwiseOR(F.shiftrightunsigned(hashed, 64 - HASH_BITS).cast("int"))


def anchor_codes(units: Column, places: Column, before: Column | None = None) -> Column:
    """The anchors at the places, as whole numbers; ``before`` is the place that the first step counts from, else 0."""
    start = F.lit(0) if before is None else before

    def code(i: Column, k: Column) -> Column:
        step = i - F.when(k == 0, start).otherwise(F.get(places, k - 1))
        return _code(step, F.xxhash64(*[units[i + j] for j in range(K)]))

    return F.transform(places, code)


def whole_code(text: Column) -> Column:
    """The one anchor of a text without syncmers; none of an empty text."""
    return F.when(F.length(text) == 0, F.array().cast("array<int>")).otherwise(F.array(_code(F.lit(WHOLE), F.xxhash64(text))))


def fingerprint_codes(text: Column) -> Column:
    """All anchors of a text in order."""
    codes = _let(word_hashes(text), lambda u: _let(syncmer_places(u), lambda p: anchor_codes(u, p)))
    return _let(codes, lambda c: F.when(F.size(c) > 0, c).otherwise(whole_code(text)))


def likeness(a: Column, b: Column) -> Column:
    """The Jaccard likeness of two texts by all their anchors (arrays without repeats): the share of those of
    either that both have.  Two empty texts are alike, an empty and another one are not."""
    common = F.size(F.array_intersect(a, b))
    return F.when(F.size(a) + F.size(b) == 0, 1.0).otherwise(
        common / F.greatest(F.size(a) + F.size(b) - common, F.lit(1))
    )


def shown(codes: Column) -> Column:
    """Eight hex digits for each anchor in text order: the step to it, and its hash."""
    return F.lower(F.array_join(F.transform(codes, lambda c: F.lpad(F.hex(c.cast("bigint")), 8, "0")), ""))


def neighbours(keyed: DataFrame) -> tuple[DataFrame, bool]:
    """Per document the key and length of the one before it in ascending order
    (before the first: the last), and whether rows repeat."""
    rows = keyed.select("unnamed", "did", "hashed", "n_chars")
    several = rows.groupBy("did", "unnamed", "hashed").agg(F.max("n_chars").alias("n_chars"), F.count(F.lit(1)).alias("n"))
    several = several.select(F.lit(0).alias("all"), "unnamed", "did", "hashed", "n_chars", "n")
    placed = with_position(several, ["all"], ["unnamed", "did", "hashed"], "place")
    top, most = placed.agg(F.max("place"), F.max("n")).first()
    before = placed.select(
        (F.col("place") % F.lit(top or 1) + 1).alias("place"),
        *[F.col(c).alias(f"before_{c}") for c in (*_KEY, "n_chars")],
    )
    return placed.join(before, "place").select(*_KEY, *[f"before_{c}" for c in (*_KEY, "n_chars")]), (most or 0) > 1


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprint every whole text and its edited text.

    The edited text has its last quarter of characters (rounded down) replaced by as many first ones
    of the next document in ascending ``doc_id``, or all it has; the first document follows the last one.
    Returns one row per input row: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, next_id, next_n_chars``.  A fingerprint has eight hex digits for each anchor:
    the words from the anchor before it (from the start for the first; 7: the text has fewer than four words, and is
    the anchor), and 28 bits of its hash.  The likeness of two fingerprints is the Jaccard likeness of their anchors.
    A null text is empty, null ids come first, rows that share an id follow by a hash of their text, rows that repeat
    both count as one document, other columns are ignored; ids may be numbers or text.  A single document follows itself; an
    empty table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    kind = docs.schema["doc_id"].dataType
    nobody = F.lit("" if isinstance(kind, T.StringType) else 0).cast(kind)
    keyed = docs.select("doc_id", text.alias("text")).select(
        "doc_id",
        F.coalesce(F.col("doc_id"), nobody).alias("did"),
        F.when(F.col("doc_id").isNull(), 0).otherwise(1).alias("unnamed"),
        F.xxhash64("text").alias("hashed"),
        F.char_length("text").cast("bigint").alias("n_chars"),
        "text",
    )
    links, repeats = neighbours(keyed)
    taken = F.floor(F.col("before_n_chars") / 4).cast("int")
    sent = keyed.join(links.hint("merge"), _KEY).select(
        *[F.col(f"before_{c}").alias(c) for c in _KEY],
        F.substr(F.col("text"), F.lit(1), taken).alias("head"),
        F.array_distinct(fingerprint_codes(F.col("text"))).alias("next_codes"),
        F.col("doc_id").alias("next_id"),
        F.col("n_chars").alias("next_n_chars"),
    )
    if repeats:
        sent = sent.dropDuplicates(_KEY)
    both = keyed.join(sent.hint("merge"), _KEY)

    cut = (F.col("n_chars") - F.floor(F.col("n_chars") / 4)).cast("int")
    rows = both.select(
        "*",
        F.substr(F.col("text"), F.lit(1), cut).alias("kept"),
        F.substr(F.col("text"), cut + 1, F.col("n_chars").cast("int")).alias("lost"),
        word_hashes(F.col("text")).alias("units"),
    )
    rows = rows.select("*", F.regexp_extract("kept", LAST_RUN, 1).alias("run"), syncmer_places(F.col("units")).alias("places"))
    # a last word that ends with the kept part may go on in the head; a word that is cut through is in the lost part, too
    ends_here = (F.col("run") != "") & ((F.col("lost") == "") | F.col("lost").rlike(f"^{BLANK}"))
    untouched = F.size("units") - F.regexp_count("lost", F.lit(WORD)) - F.when(ends_here, 1).otherwise(0)
    rows = rows.select("*", untouched.alias("safe"), anchor_codes(F.col("units"), F.col("places")).alias("found"))
    back = F.least("safe", F.lit(K - 1))
    rows = rows.select(
        "*",
        F.concat(F.slice("units", F.col("safe") - back + 1, back), word_hashes(F.concat("run", "head"))).alias("seam"),
        F.size(F.filter("places", lambda i: i <= F.col("safe") - K)).alias("held"),
        F.when(F.size("found") > 0, F.col("found")).otherwise(whole_code(F.col("text"))).alias("codes"),
        F.concat("kept", "head").alias("edited"),
    )
    rows = rows.select("*", syncmer_places(F.col("seam")).alias("seam_places"))
    # the last anchor before the seam, counted from the seam's first word
    since = F.coalesce(F.get("places", F.col("held") - 1), F.lit(0)) - (F.col("safe") - back)
    rows = rows.select("*", anchor_codes(F.col("seam"), F.col("seam_places"), since).alias("later"))
    rows = rows.select("*", F.concat(F.slice("found", F.lit(1), F.col("held")), "later").alias("joined"), shown(F.col("codes")).alias("fingerprint"))
    none = F.size("joined") == 0
    alone = whole_code(F.col("edited"))
    edited = F.when(none, alone).otherwise(F.col("joined"))
    rows = rows.select("*", F.array_distinct("codes").alias("own"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        F.when(none, shown(alone))
        .otherwise(F.concat(F.substr(F.col("fingerprint"), F.lit(1), 8 * F.col("held")), shown(F.col("later"))))
        .alias("edited_fingerprint"),
        likeness(F.col("own"), F.array_distinct(edited)).alias("near_edited"),
        likeness(F.col("own"), F.col("next_codes")).alias("near_next"),
        "next_id",
        "next_n_chars",
    )
