"""Bracketed trees as a table of nodes, and back.

A tree is read inside its row: a fold over its brackets keeps the open nodes on a stack and hands
out a node when it closes.  The table then serves label counts, leaf counts and rules without reading text again.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.functions import arrow_parse as P
from textmill.functions import arrow_text

#: Brackets, and what stands between them and blanks.
PIECE = r"\(|\)|[^()\s]+"
#: Tags whose leaves make a noun phrase, and those that open a prepositional one.
NOUN_TAGS = ("DT", r"PRP\$", "JJ", "JJS", "CD", "NN", "NNS", "NNP")
LINKING_TAGS = ("IN", "TO")
#: Trees that are read at once.
TREES = 2_000


def chunk_tree(tagged: Column) -> Column:
    """A tree with noun phrases and prepositional phrases over the tags: ``(ROOT (S (NP (DT the) (NN dog)) ...))``."""
    # every noun leaf a phrase of its own, then neighbours as one; no repeated group, which Java would follow by recursion
    nouns = F.regexp_replace(arrow_text.shallow_tree(tagged), rf"(\((?:{'|'.join(NOUN_TAGS)}) [^() ]+\))", "(NP $1)")
    merged = F.regexp_replace(nouns, r"\)\) \(NP \(", ") (")
    # a tab marks the phrases that a linking word opens, until their end is found
    linked = F.regexp_replace(merged, rf"(\((?:{'|'.join(LINKING_TAGS)}) [^() ]+\)) \(NP ", "(PP $1 (NP\t")
    return F.regexp_replace(linked, r"\(NP\t(.*?)\)\)", "(NP $1)))")


def tree_nodes(tree: Column) -> Column:
    """The nodes of a tree in the order in which they open.

    Array of ``(node, parent, depth, label, word, start, end)``: nodes are numbered from 0, the top one has no parent, ``word``
    is null but for leaves, and a node spans the words ``start`` to before ``end``.  A bracket without a label has an empty
    one; a closing bracket too many, and what never closes, are left out.
    """
    pieces = F.regexp_extract_all(tree, F.lit(PIECE), F.lit(0))

    def around(ps: Column) -> Column:
        def piece(p: Column, i: Column) -> Column:
            before, after = F.get(ps, i - 1), F.get(ps, i + 1)
            return F.struct(
                p.alias("p"),
                F.coalesce(before == "(", F.lit(False)).alias("label"),
                F.when(after.isin("(", ")"), F.lit("")).otherwise(after).alias("next"),
            )

        return F.transform(ps, piece)

    opened = "struct<node:int,parent:int,label:string,start:int,word:string>"
    closed = "struct<node:int,parent:int,depth:int,label:string,word:string,start:int,end:int>"
    start = F.struct(
        F.array().cast(f"array<{opened}>").alias("stack"), F.array().cast(f"array<{closed}>").alias("out"),
        F.lit(0).alias("nodes"), F.lit(0).alias("words"),
    )

    def step(acc: Column, x: Column) -> Column:
        depth = F.size(acc["stack"])
        top = F.get(acc["stack"], depth - 1)
        new = F.struct(
            acc["nodes"].alias("node"), top["node"].alias("parent"), F.coalesce(x["next"], F.lit("")).alias("label"),
            acc["words"].alias("start"), F.lit(None).cast("string").alias("word"),
        )
        done = F.struct(
            top["node"].alias("node"), top["parent"].alias("parent"), (depth - 1).alias("depth"), top["label"].alias("label"),
            top["word"].alias("word"), top["start"].alias("start"), acc["words"].alias("end"),
        )
        # the first word below a node without other nodes makes it a leaf
        named = F.struct(
            top["node"].alias("node"), top["parent"].alias("parent"), top["label"].alias("label"), top["start"].alias("start"),
            F.coalesce(top["word"], x["p"]).alias("word"),
        )
        rest = F.slice(acc["stack"], F.lit(1), F.greatest(depth - 1, F.lit(0)))

        def state(stack: Column, out: Column, nodes: Column, words: Column) -> Column:
            return F.struct(stack.alias("stack"), out.alias("out"), nodes.alias("nodes"), words.alias("words"))

        same = (acc["nodes"], acc["words"])
        return (
            F.when(x["p"] == "(", state(F.concat(acc["stack"], F.array(new)), acc["out"], acc["nodes"] + 1, acc["words"]))
            .when((x["p"] == ")") & (depth > 0), state(rest, F.concat(acc["out"], F.array(done)), *same))
            .when((x["p"] == ")") | x["label"] | (depth == 0), acc)
            .otherwise(state(F.concat(rest, F.array(named)), acc["out"], acc["nodes"], acc["words"] + 1))
        )

    bound = F.transform(F.array(pieces), around)
    return F.array_sort(F.aggregate(F.get(bound, F.lit(0)), start, step, lambda acc: acc["out"]))


def tree_spans(trees: DataFrame, *keep: str, column: str = "tree", arrow: bool = False) -> DataFrame:
    """``(keep..., node, parent, depth, label, word, start, end)``, one row per node; nothing is shuffled.

    The fold takes steps for every bracket; with ``arrow`` Python workers read all trees of a batch at once.
    """
    if not arrow:
        return trees.select(*keep, F.inline(tree_nodes(F.col(column))))
    rows = trees.select(*keep, F.col(column).alias("_tree"))
    schema = T.StructType([*rows.select(*keep).schema.fields, *[T.StructField(c, T.StringType() if c in ("label", "word") else T.IntegerType()) for c in P.NODE]])
    names, table = schema.names, P.tree_table

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TREES):
                some = batch.slice(at, TREES)
                row, columns = table(some.column(some.num_columns - 1))
                place = pa.array(row)
                yield pa.record_batch([*[c.take(place) for c in some.columns[:-1]], *columns], names)

    return rows.mapInArrow(run, schema)


def tree_text(spans: DataFrame, *keep: str) -> DataFrame:
    """``(keep..., tree)``: the trees of a span table, printed with one blank between nodes.

    A group is the nodes of one sentence.
    """
    node = F.struct("node", "depth", "label", "word")
    trees = spans.groupBy(*keep).agg(F.array_sort(F.collect_list(node)).alias("_nodes"))

    def printed(x: Column, i: Column) -> Column:
        following = F.coalesce(F.get(F.col("_nodes"), i + 1)["depth"], F.lit(0))
        closing = F.greatest(x["depth"] - following + 1, F.lit(0))
        return F.concat(
            F.lit("("), x["label"], F.coalesce(F.concat(F.lit(" "), x["word"]), F.lit("")), F.repeat(F.lit(")"), closing)
        )

    # below the last node everything closes
    return trees.select(*keep, F.array_join(F.transform("_nodes", printed), " ").alias("tree"))


def annotated_trees(bodies: DataFrame, *keep: str) -> DataFrame:
    """``(keep..., sent_idx, tree)`` of annotated ``body`` texts: lines that are trees, numbered among all lines that are not blank."""
    lines = F.filter(F.split("body", "\n"), lambda line: F.trim(line) != "")
    rows = bodies.select(*keep, F.posexplode(lines).alias("sent_idx", "tree"))
    return rows.where(F.startswith("tree", F.lit("(")))


def label_counts(spans: DataFrame) -> DataFrame:
    """``label, n``: how many nodes have each label."""
    return spans.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def rule_counts(spans: DataFrame, *keep: str) -> DataFrame:
    """``label, children, n``: how often a node of a label has these labels below it, in order.

    The children of a node are gathered inside its sentence, in one group per node.
    """
    known = spans.where(" and ".join(f"`{c}` is not null" for c in keep)) if keep else spans
    nothing = F.lit(None)
    child = F.struct(F.col("node").alias("k"), F.col("label").alias("l"))
    # a node and its children meet in one shuffle: it sends its label to itself, and itself to its parent
    sent = F.array(
        F.struct(F.col("node").alias("node"), F.struct(F.col("label").alias("l")).alias("own"), nothing.cast("struct<k:int,l:string>").alias("child")),
        F.struct(F.col("parent").alias("node"), nothing.cast("struct<l:string>").alias("own"), child.alias("child")),
    )
    met = known.select(*keep, F.inline(sent)).where("node is not null").groupBy(*keep, "node").agg(
        F.collect_list("own").alias("own"), F.array_sort(F.collect_list("child")).alias("ls")
    )
    named = met.where(F.size("ls") > 0).select(F.explode("own").alias("own"), "ls")
    rows = named.select(F.col("own.l").alias("label"), F.array_join(F.transform("ls", lambda x: x["l"]), " ").alias("children"))
    return rows.groupBy("label", "children").agg(F.count(F.lit(1)).alias("n"))
