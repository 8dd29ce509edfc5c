"""Sentence and token expressions; everything stays inside the document's row.

A document is one row, so splitting and tagging it in array expressions needs
no shuffle at any scale.  Explode only where rows are the wanted result.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill import constants as K
from textmill.functions.strings import trimmed

SENTENCE_PATTERN = "[^.!?]+[.!?]*"
TOKEN_PATTERN = r"[\p{L}\p{N}]+|[^\t\n\x0b\x0c\r \p{L}\p{N}]"
WORD_PATTERN = r"[\p{L}\p{N}]+"


def sentence_array(text: Column) -> Column:
    """Non-empty trimmed sentences in order."""
    pieces = F.regexp_extract_all(text, F.lit(SENTENCE_PATTERN), F.lit(0))
    return F.filter(F.transform(pieces, trimmed), lambda s: s != "")


def token_array(sentence: Column) -> Column:
    """Words and single punctuation marks in order."""
    return F.regexp_extract_all(sentence, F.lit(TOKEN_PATTERN), F.lit(0))


def word_array(text: Column) -> Column:
    """Lower-cased words of the whole text in order, without punctuation."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0))


def tag(token: Column, low: Column) -> Column:
    """Part-of-speech tag of one token by closed-class words, shape and suffix.

    ``low`` is the lower-cased token, computed once by the caller.
    """
    first = F.substring(token, 1, 1)
    closed = F.when(F.lit(False), F.lit(""))
    for name, words in K.CLOSED_CLASS.items():
        closed = closed.when(low.isin(*words), F.lit(name))
    latin = first.between("a", "z") | first.between("A", "Z")
    out = F.when(token.isin(".", "!", "?"), F.lit("."))
    out = out.when(token.isin(",", ";", ":"), token)
    # one hash lookup tells most words from the closed classes
    out = out.when(low.isin(*[w for words in K.CLOSED_CLASS.values() for w in words]), closed)
    out = out.when(~latin & ~token.rlike(r"^[\p{L}\p{N}]"), F.lit("SYM"))
    out = out.when(first.between("0", "9") & token.rlike("^[0-9]+$"), F.lit("CD"))
    out = out.when(first != F.substring(low, 1, 1), F.lit("NNP"))
    for suffix, name in K.SUFFIX_TAGS:
        out = out.when(F.endswith(low, F.lit(suffix)), F.lit(name))
    return out.otherwise(F.lit("NN"))


def tagged_array(tokens: Column) -> Column:
    """Array of ``(tok, tag)`` from an array of tokens."""
    with_low = F.transform(tokens, lambda t: F.struct(t.alias("tok"), F.lower(t).alias("low")))
    return F.transform(with_low, lambda x: F.struct(x["tok"].alias("tok"), tag(x["tok"], x["low"]).alias("tag")))


def pairs_of(items: Column) -> Column:
    """Neighbours ``(a, b)`` of an array, in order; null below two items.

    Pass a column or a lambda's variable, not an expression: it is used often.
    """
    size = F.size(items)
    return F.when(
        size >= 2,
        F.zip_with(
            F.slice(items, F.lit(1), size - 1),
            F.slice(items, F.lit(2), size - 1),
            lambda a, b: F.struct(a.alias("a"), b.alias("b")),
        ),
    )


def pos_line(tagged: Column) -> Column:
    """``word/TAG word/TAG `` with the trailing blank of the line format."""
    return F.array_join(F.transform(tagged, lambda w: F.concat(w["tok"], F.lit("/"), w["tag"], F.lit(" "))), "")


def bracketed(token: Column) -> Column:
    """Token as a tree leaf: brackets take their Penn names."""
    return F.when(token == "(", F.lit("-LRB-")).when(token == ")", F.lit("-RRB-")).otherwise(token)


def skip_marker(size: Column) -> Column:
    return F.concat(F.lit("[SKIPPED LONG SENTENCE: "), size.cast("string"), F.lit(" words]"))


def shallow_tree(tagged: Column) -> Column:
    """Flat bracketed tree over the tags: ``(ROOT (S (DT the) (NN dog)))``."""
    leaves = F.transform(
        tagged, lambda w: F.concat(F.lit("("), w["tag"], F.lit(" "), bracketed(w["tok"]), F.lit(")"))
    )
    return F.concat(F.lit("(ROOT (S "), F.array_join(leaves, " "), F.lit("))"))


def constituency_line(tagged: Column, max_tokens: int = K.MAX_SENTENCE_TOKENS) -> Column:
    """Tree of a sentence, or the skip marker if it is too long."""
    return F.when(F.size(tagged) > max_tokens, skip_marker(F.size(tagged))).otherwise(shallow_tree(tagged))


def relation(name: Column) -> Column:
    out = None
    for tag_name, rel in K.SHALLOW_RELATIONS.items():
        if tag_name != "PUNCT":
            out = F.when(name == tag_name, rel) if out is None else out.when(name == tag_name, rel)
    out = out.when(name.isin(".", ",", ";", ":", "SYM"), K.SHALLOW_RELATIONS["PUNCT"])
    return out.otherwise("dep")


def shallow_edges(tagged: Column) -> Column:
    """Array of ``rel(head-i, dep-j)``: each token hangs on its right neighbour."""
    size = F.size(tagged)

    def edge(word: Column, i: Column) -> Column:
        last = i == size - 1
        # past the end the array gives null, which the root edge replaces
        right = F.get(tagged, i + 1)
        return F.concat(
            F.when(last, "root").otherwise(relation(word["tag"])),
            F.lit("("),
            F.when(last, "ROOT-0").otherwise(F.concat(right["tok"], F.lit("-"), (i + 2).cast("string"))),
            F.lit(", "),
            word["tok"],
            F.lit("-"),
            (i + 1).cast("string"),
            F.lit(")"),
        )

    return F.transform(tagged, edge)


def dependency_block(tagged: Column) -> Column:
    return F.array_join(shallow_edges(tagged), "\n")
