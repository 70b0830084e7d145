"""Document fingerprints by spot signatures, on DataFrame functions only.

A spot is a common word; its signature is the chain of the next content words.
Common words stand throughout running text and in few other places, so the set of
a text's signatures is its fingerprint. Sets are compared by Jaccard
similarity. To find similar sets, they are partitioned by length, so that only
neighbouring partitions can meet, and indexed by their rarest signatures.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm.linking import class_ids, linked
from cellweave.llm.shared import lower_ascii, saved, sha256_hex
from cellweave.plans.skew import broadcast_if_small

# Common words of English, French, German and Spanish.
ANCHORS = (
    "a and are as at be by for from has have he in is it not of on or that the this to was were with you "
    "au avec ce dans des du elle en est et il la le les mais ne pas pour que qui se sur un une "
    "als auch auf aus bei das dem den der die ein eine für ich im ist mit nicht sie sich und von zu "
    "al como con del el es lo los las más no o para por sin su y"
).split()
# Content words in a chain, and how many words after the anchor may hold them.
CHAIN, REACH = 2, 6
SIMILARITY = 0.8
_SIGN = -(2**63)


def signatures(text: Column) -> Column:
    """The set of spot signatures of ``text`` as sorted ints; empty for NULL and for texts without words.

    A text without any spot takes the chains of all its words instead.
    """
    words = F.filter(F.split(lower_ascii(F.coalesce(text.cast("string"), F.lit(""))), r"[\x09-\x0D\x20]+"), lambda w: w != "")
    # Common words become negative numbers, all others positive ones.
    numbered = F.transform(
        words,
        lambda w: F.when(w.isin(ANCHORS), F.xxhash64(w).bitwiseOR(F.lit(_SIGN))).otherwise(
            F.xxhash64(w).bitwiseAND(F.lit(~_SIGN))
        ),
    )

    def chains(n: Column) -> Column:
        def chain(x: Column, i: Column) -> Column:
            content = F.filter(F.slice(n, i + 2, REACH), lambda y: y >= 0)
            return F.when(x < 0, _short(F.xxhash64(x, F.slice(content, 1, CHAIN))))

        return F.filter(F.transform(n, chain), lambda s: s.isNotNull())

    def plain(n: Column) -> Column:
        return F.transform(n, lambda x, i: _short(F.xxhash64(x, F.slice(n, i + 2, CHAIN))))

    def of(n: Column) -> Column:
        return F.when(F.exists(n, lambda x: x < 0), chains(n)).otherwise(plain(n))

    return F.array_sort(F.array_distinct(F.element_at(F.transform(F.array(numbered), of), 1)))


def _short(hash_of: Column) -> Column:
    return F.shiftright(hash_of, 32).cast("int")


def encoded(signs: Column) -> Column:
    """A set of signatures as text, eight hex digits each."""
    return F.concat_ws("", F.transform(signs, lambda s: F.lpad(F.hex(s.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets; 1 if both are empty."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(union == 0, 1.0).otherwise(common / union)


def edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of the texts of ``docs`` (``doc_id``, ``text``) and of edited ones.

    The edited text has its last half replaced by the first characters of the
    next document's, in descending order of ids; the first document follows the last.
    Of rows with one id, the one whose text hashes least is that id's; rows
    without an id, and ids that stand alone, are as ``successors`` says. NULL texts are empty.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n_chars = F.char_length("text").cast("long")
    ids = texts.filter("doc_id IS NOT NULL").select("doc_id", n_chars.alias("n"), F.xxhash64("text").alias("pick"))
    ids = ids.groupBy("doc_id").agg(F.max("n").alias("n"), F.min("pick").alias("pick"), F.count("*").alias("rows"))
    ids = saved(ids, "spot-ids")
    repeated = not ids.filter("rows > 1").isEmpty()
    links = successors(ids.select("doc_id"))
    target = ids.select(F.col("doc_id").alias("target"), F.floor(F.col("n") / 2).cast("int").alias("need"))
    links = links.join(target, "target").join(ids.select("doc_id", "pick"), "doc_id")
    links = saved(links.select(F.col("doc_id").alias("sender"), "target", "need", "pick"), "spot-links")
    sent = texts.join(broadcast_if_small(links), F.col("doc_id") == F.col("sender"))
    if repeated:
        sent = sent.filter(F.xxhash64("text") == F.col("pick"))
    sent = sent.select("target", F.expr("left(text, need)").alias("head"), signatures(F.col("text")).alias("next_signs"))
    if repeated:
        sent = sent.dropDuplicates(["target"])
    # A text's own set is made after the join: it is cheaper to make twice than to shuffle.
    joined = texts.join(sent, F.col("doc_id") == F.col("target"), "left")
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.char_length("text") - half),
        F.coalesce(F.substring("head", F.lit(1), half), F.lit("")),
    )
    none = F.array().cast("array<int>")
    changed = joined.select(
        "doc_id",
        n_chars.alias("n_chars"),
        signatures(F.col("text")).alias("signs"),
        F.coalesce("next_signs", none).alias("next_signs"),
        edited.alias("edited"),
    ).withColumn("edited_signs", signatures(F.col("edited")))
    return changed.select(
        "doc_id",
        "n_chars",
        sha256_hex(F.col("edited")).alias("edited_sha256"),
        encoded(F.col("signs")).alias("fingerprint"),
        encoded(F.col("edited_signs")).alias("edited_fingerprint"),
        likeness(F.col("signs"), F.col("edited_signs")).alias("near_edited"),
        likeness(F.col("signs"), F.col("next_signs")).alias("near_next"),
    )


def successors(ids: DataFrame) -> DataFrame:
    """For each of the distinct ``doc_id``, ``target``: the least greater id, or the least of all after the greatest.

    Ids are looked up in a tree over their bits, 14 a level: in each node by a
    window of at most 2**14 rows, then in the level above. One id alone follows itself.
    """
    level = ids.select(F.col("doc_id").alias("key"), F.col("doc_id").alias("low"))
    found = ids
    ends = ids.agg(F.min("doc_id").alias("first")).first()["first"]
    steps = []
    for depth in range(5):
        parent = F.shiftright("key", 14) if depth < 4 else F.lit(0).cast("long")
        level = level.withColumn("parent", parent)
        after = F.lead("low").over(Window.partitionBy("parent").orderBy("key"))
        steps.append(level.select(F.col("key").alias(f"_k{depth}"), after.alias(f"_after{depth}")))
        level = saved(level.groupBy("parent").agg(F.min("low").alias("low")).withColumnRenamed("parent", "key"), "spot-level")
    for depth, step in enumerate(steps):
        key = F.shiftright("doc_id", 14 * depth) if depth else F.col("doc_id")
        found = found.join(broadcast_if_small(step.filter(f"_after{depth} IS NOT NULL")), key == F.col(f"_k{depth}"), "left")
    return found.select("doc_id", F.coalesce(*(f"_after{d}" for d in range(5)), F.lit(ends).cast("long")).alias("target"))


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id`` and ``class_id``, the least id among those with like fingerprints, for each row of ``docs``.

    Texts with equal sets are one class, and so are those that links of
    ``similarity`` or more connect. A set meets others in its own length
    partition and the next one, at its rarest signatures, of which two sets of that
    similarity share one. Texts without words form one class.
    """
    signed = docs.select("doc_id", signatures(F.col("text")).alias("signs"))
    signed = saved(signed.withColumn("node", F.unhex(F.md5(encoded(F.col("signs"))))), "spot-sets")
    nodes = saved(signed.groupBy("node").agg(F.min("doc_id").alias("least")), "spot-nodes")
    sets = saved(signed.select("node", "signs").dropDuplicates(["node"]), "spot-nodes")
    common = sets.select(F.explode("signs").alias("sign")).groupBy("sign").agg(F.count("*").alias("texts"))
    ranked = sets.select("node", F.size("signs").alias("n"), F.explode("signs").alias("sign")).join(common, "sign")
    order = Window.partitionBy("node").orderBy("texts", "sign")
    rare = ranked.withColumn("_at", F.row_number().over(order)).filter(
        F.col("_at") <= F.col("n") - F.ceil(F.col("n") * similarity) + 1
    )
    # Sets of the given similarity differ in length by less than one step, so they share a partition or stand in two adjacent ones.
    step = F.floor(F.log(F.col("n").cast("double")) / math.log(1 / similarity))
    rows = rare.select("node", F.explode(F.array(step, step + 1)).alias("part"), "sign")
    rows = rows.select("node", F.xxhash64("part", "sign").alias("bucket"))

    def judge(pairs: DataFrame) -> DataFrame:
        mine = sets.select("node", F.col("signs").alias("a"))
        theirs = sets.select(F.col("node").alias("leader"), F.col("signs").alias("b"))
        both = pairs.join(mine, "node").join(theirs, "leader")
        return both.select("node", "leader", likeness(F.col("a"), F.col("b")).alias("overlap"))

    links = linked(saved(rows, "spot-index"), judge, similarity, sets.select("node", F.size("signs").alias("size")))
    return class_ids(signed.select("doc_id", "node"), nodes, links).select("doc_id", "class_id")
