"""Exact Jaccard join of word-shingle sets with set-relation skipping.

Documents with equal sets are one class, so copies are never paired. Each text is shingled
into a set once; sets whose first elements meet no other set's are left out, and the others
are written as a table that all later steps read. Their elements are counted, and each set
posts its first elements, rare ones before frequent ones, to index lists.

Skipping by position: an entry at position k of a set of n elements, if it is the first
that two linked sets share, admits partners of at most ``reach`` elements (what is left of
the set must hold the whole overlap). Lists are read in blocks of like size; an entry visits
only blocks whose sizes and reaches admit it and whose sets aren't joined with it already,
and only such a visit becomes a row.

Answers from similar sets: every list's leader answers first for its members. The overlap
with a leader is kept, and two sets with one leader are not compared where the elements that
they lack of it or have beside it leave too little in common. Inside a cell, overlaps are
derived from the differences to a similar set.

The order of the elements is a matter of speed only; the links are exact for any order.
Shingles and sets are identified by 64-bit hashes (a set also by its size).

Defined cases: a null or empty text, or one of white space only, has an empty set, links
with nothing and is its own component; a text with fewer words than a shingle has one
element; repeated rows and equal sets share a component; rows with a null doc_id take part
and bridge others, but don't name a component (it is null where all its rows' ids are); only
doc_id and text are read, so other columns, whatever their names, change nothing; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm.common import batch_of, discard, distinct, release, releasing, small_side, stage, utf8, window_hashes, word_hashes
from pricelake.llm.components import components

#: Elements ordered by their count: those of at least FREQUENT_SETS sets, and of the most
#: sets if there are more than FREQUENT_LIMIT of them (9 bytes each on every executor).
FREQUENT_LIMIT, FREQUENT_SETS = 1_000_000, 2
#: Up to so many rows of a few numbers are sent to every executor; beyond, both sides are shuffled.
BROADCAST_ROWS = 300_000
#: The same for rows of one number.
BROADCAST_NUMBERS = 500_000
#: The first round posts one element more for every so many.
MORE = 40
#: Leaders that a set asks in each of so many rounds; a matter of speed only.
LEADERS, LEADER_ROUNDS = 2, 2
#: Elements of the sets that meet in one task, at most about twice as many.
CELL_ELEMENTS = 60_000
#: Blocks of like size in a factor 100 / percent of sizes.
BLOCKS = 4


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """Distinct shingles' hashes, ascending; A-Z lower-cased, no other sign changed."""
    words = word_hashes(text.lower())
    return distinct(window_hashes(words, min(width, len(words)))) if len(words) else words


def prefix_length(n: int, percent: int) -> int:
    """So many first elements of two linked sets of size n or more have one in common."""
    return n - -(-percent * n // 100) + 1


def set_id(elements: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(elements.tobytes()) - (1 << 63)


def reach(n: Column, pos: Column, percent: int) -> Column:
    """Most elements of a linked set with which the element at ``pos`` is the first in common."""
    return F.floor((100 + percent) * (n - pos).cast("long") / percent).cast("long") - n


def ordered(elements: np.ndarray, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The global order: by rank (0 for elements that aren't frequent), each part by hash."""
    if not len(frequent) or not len(elements):
        return elements
    at = np.minimum(np.searchsorted(frequent, elements), len(frequent) - 1)
    return elements[np.argsort(np.where(frequent[at] == elements, rank[at], 0), kind="stable")]


DIGEST = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n", pa.int64()), ("set_id", pa.int64()), ("first", pa.list_(pa.int64()))])
SET = pa.schema([("set_id", pa.int64()), ("n", pa.int32()), ("elements", pa.list_(pa.int64()))])
POSTING = pa.schema([("element", pa.int64()), ("set_id", pa.int64()), ("n", pa.int32()), ("pos", pa.int32())])


def lists_of(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(arrays).view(np.int64) if arrays else [], pa.int64()))


def unseen(name: int, seen: set[int]) -> bool:
    """Whether a task meets a set for the first time; forgets nothing, stops noting at a million."""
    if name in seen:
        return False
    if len(seen) < 1_000_000:
        seen.add(name)
    return True


def _digests(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Of every document row: doc_id, text_key, n, set_id, and its first elements by hash.

    With m elements more than the prefix posted on both sides, two linked sets share at
    least 1 + m of them. A task posts a set once, however many rows have it.
    """

    @releasing
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            sizes, names, firsts = [], [], []
            for text in utf8(batch["text"]):
                elements = shingle_set(text, width)
                n, name = len(elements), set_id(elements)
                sizes.append(n)
                names.append(name)
                firsts.append(elements[: prefix_length(n, percent) + n // MORE if n and unseen(name, seen) else 0])
            yield pa.RecordBatch.from_arrays([batch["doc_id"].cast(pa.int64()), batch["text_key"], pa.array(sizes, pa.int64()), pa.array(names, pa.int64()), lists_of(firsts)], schema=DIGEST)

    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    return keyed.mapInArrow(digest, "doc_id long, text_key long, n long, set_id long, first array<long>")


def _suspects(digests: DataFrame, percent: int) -> DataFrame:
    """set_id and class_doc of each set that may have a partner, by hash order alone."""
    posted = digests.filter(F.size("first") > 0)
    entries = posted.select("set_id", "n", F.explode("first").alias("element"))
    lists = entries.groupBy("element").agg(F.min("set_id").alias("low"), F.max("set_id").alias("high")).filter("low <> high").select("element")
    lists = stage(lists, "jaccard-met")
    met = entries.join(small_side(lists, BROADCAST_NUMBERS), "element").groupBy("set_id", "n").agg(F.count("*").alias("met"))
    classes = digests.filter("n > 0").groupBy("set_id", "n").agg(F.min("doc_id").alias("class_doc"), F.count(F.when(F.size("first") > 0, 1)).alias("times"))
    least = 1 + F.floor(F.floor(percent * F.col("n") / 100) / MORE)  # a partner has percent * n / 100 elements or more
    suspects = stage(met.join(classes, ["set_id", "n"]).filter(F.col("met") >= F.col("times") * least).select("set_id", "class_doc"), "jaccard-suspects")
    discard(lists)
    return suspects


def _sets(docs: DataFrame, suspects: DataFrame, width: int) -> DataFrame:
    """set_id, n and elements of the suspects' sets; a set may occur more than once."""

    @releasing
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            rows = [(name, s) for s in (shingle_set(text, width) for text in utf8(batch["text"])) if len(s) and unseen(name := set_id(s), seen)]
            yield pa.RecordBatch.from_arrays([pa.array([name for name, _ in rows], pa.int64()), pa.array([len(s) for _, s in rows], pa.int32()), lists_of([s for _, s in rows])], schema=SET)

    wanted = small_side(suspects.filter("class_doc IS NOT NULL").select(F.col("class_doc").alias("doc_id")).distinct(), BROADCAST_ROWS)
    texts = docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi")
    if not suspects.filter("class_doc IS NULL").isEmpty():
        texts = texts.unionByName(docs.filter("doc_id IS NULL").select("doc_id", "text"))
    return stage(texts.select("text").mapInArrow(read, "set_id long, n int, elements array<long>"), "jaccard-sets")


def _frequent(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Elements of the most sets, ascending, at most FREQUENT_LIMIT, and their ranks by the logarithm of the count."""
    counts = sets.select(F.explode("elements").alias("element")).groupBy("element").agg(F.count("*").alias("sets")).filter(F.col("sets") >= FREQUENT_SETS)
    counts = stage(counts, "jaccard-counts")
    least, held = FREQUENT_SETS, 0
    for row in counts.groupBy(F.least("sets", F.lit(10_000)).alias("sets")).agg(F.count("*").alias("n")).orderBy(F.desc("sets")).collect():
        held += row.n
        if held > FREQUENT_LIMIT:
            least = row.sets + 1
            break
    chosen = counts.filter(F.col("sets") >= least).select("element", F.floor(F.log2("sets")).cast("byte").alias("rank")).toArrow()
    discard(counts)
    elements, rank = chosen["element"].to_numpy().view(np.uint64), chosen["rank"].to_numpy()
    order = np.argsort(elements)
    return elements[order], rank[order]


def _entries(sets: DataFrame, percent: int) -> DataFrame:
    """Index entries that may meet another's: element, set_id, n, reach."""
    sent = sets.sparkSession.sparkContext.broadcast(_frequent(sets))
    release()

    @releasing
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, rank = sent.value
        for batch in batches:
            arrays, names = batch["elements"], batch["set_id"].to_numpy()
            values, ends = arrays.values.to_numpy().view(np.uint64), arrays.offsets.to_numpy()
            firsts = [ordered(values[a:b], frequent, rank)[: prefix_length(b - a, percent)] for a, b in zip(ends, ends[1:])]
            sizes = np.array([len(f) for f in firsts], np.int64)
            columns = [np.concatenate([*firsts, values[:0]]).view(np.int64), np.repeat(names, sizes), np.repeat(np.diff(ends), sizes), np.concatenate([*map(np.arange, sizes), sizes[:0]])]
            yield batch_of(POSTING, *(c.astype(f.type.to_pandas_dtype()) for c, f in zip(columns, POSTING)))

    postings = sets.select("set_id", "elements").mapInArrow(post, "element long, set_id long, n int, pos int")
    postings = stage(postings.select("element", "set_id", "n", reach(F.col("n"), F.col("pos"), percent).alias("reach")), "jaccard-postings")
    lists = postings.groupBy("element").agg(F.min("set_id").alias("low"), F.max("set_id").alias("high"), F.min("n").alias("least"), F.max("reach").alias("most"))
    lists = stage(lists.filter("low <> high").select("element", "least", "most"), "jaccard-lists")
    met = postings.join(small_side(lists, BROADCAST_ROWS), "element").filter("least <= reach AND n <= most").select("element", "set_id", "n", "reach")
    entries = stage(met.dropDuplicates(["element", "set_id"]), "jaccard-entries")
    discard(postings, lists)
    return entries


def _enough(overlap: Column, n_a: Column, n_b: Column, percent: int) -> Column:
    """100 * overlap >= percent * union, in whole numbers."""
    return (100 + percent) * overlap.cast("long") >= percent * (n_a.cast("long") + n_b.cast("long"))


class Answers:
    """Overlaps among sets that lie in one cell, derived from their overlaps with one of them.

    For a reference R with |a & R| known, a set is R without some elements and with others;
    of two sets, overlap = |R| - |R\\a| - |R\\b| + |(R\\a) & (R\\b)| + |(a\\R) & (b\\R)|, which
    touches only the differences. Sets unlike every reference become references.
    """

    #: A set within this Jaccard similarity of a reference is kept as differences.
    SIMILAR = 0.6

    def __init__(self, sets: dict[int, np.ndarray]):
        self.sets, self.references, self.of = sets, [], {}

    def _described(self, name: int) -> tuple[int, frozenset, frozenset]:
        if name not in self.of:
            own = self.sets[name]
            for k, r in enumerate(self.references[-4:], max(0, len(self.references) - 4)):
                common = len(np.intersect1d(own, r, assume_unique=True)) if 0.6 < len(own) / len(r) < 1.7 else 0
                if common >= self.SIMILAR * (len(own) + len(r) - common):
                    self.of[name] = (k, frozenset(np.setdiff1d(r, own, assume_unique=True).tolist()), frozenset(np.setdiff1d(own, r, assume_unique=True).tolist()))
                    break
            else:
                self.references.append(own)
                self.of[name] = (len(self.references) - 1, frozenset(), frozenset())
        return self.of[name]

    def overlap(self, a: int, b: int) -> int:
        (ra, minus_a, plus_a), (rb, minus_b, plus_b) = self._described(a), self._described(b)
        if ra != rb:
            return len(np.intersect1d(self.sets[a], self.sets[b], assume_unique=True))
        return len(self.references[ra]) - len(minus_a) - len(minus_b) + len(minus_a & minus_b) + len(plus_a & plus_b)


def _overlaps(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs (a, b, n_a, n_b) with the overlap of their whole sets.

    Sets travel once per cell, not once per pair: a set's home is the partner with the most
    partners, homes of many elements are cut into parts, and a cell is a pair of parts.
    """
    both = pairs.select(F.col("a").alias("node"), F.col("n_a").alias("n"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("node"), F.col("n_b").alias("n"), F.col("a").alias("other")))
    degrees = stage(both.groupBy("node", "n").agg(F.count("*").alias("degree")), "jaccard-degrees")
    of_other = small_side(degrees.select(F.col("node").alias("other"), F.col("degree").alias("others")), BROADCAST_ROWS)
    best = both.join(of_other, "other").groupBy("node").agg(F.max(F.struct("others", "other")).alias("best"))
    hub = F.when(F.struct("degree", "node") > F.struct("best.others", "best.other"), F.col("node")).otherwise(F.col("best.other"))
    homes = stage(degrees.join(best, "node").select("node", "n", hub.alias("hub")), "jaccard-homes")
    parts = homes.groupBy("hub").agg(F.ceil(F.sum("n") / CELL_ELEMENTS).alias("parts"))
    parts = stage(homes.join(small_side(parts, BROADCAST_ROWS), "hub").select("node", F.xxhash64("hub", F.pmod(F.xxhash64("node"), F.col("parts"))).alias("home")), "jaccard-parts")
    near = small_side(parts, BROADCAST_ROWS)
    side = lambda x: near.select(F.col("node").alias(x), F.col("home").alias(f"{x}_home"))
    cell = F.xxhash64(F.least("a_home", "b_home"), F.greatest("a_home", "b_home"))
    placed = stage(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", cell.alias("cell")), "jaccard-cells")
    visits = placed.select(F.col("a").alias("set_id"), "cell").union(placed.select("b", "cell")).distinct()
    visits = stage(visits.groupBy("set_id").agg(F.collect_list("cell").alias("cells")), "jaccard-visits")
    sent = sets.join(small_side(visits, BROADCAST_ROWS), "set_id").select(F.explode("cells").alias("cell"), "set_id", "elements")

    def answer(key, there: pa.Table, cell_pairs: pa.Table) -> pa.Table:
        elements = {}
        for name, values in zip(there["set_id"].to_pylist(), there["elements"].combine_chunks()):
            elements.setdefault(name, values.values.to_numpy().view(np.uint64))
        answers = Answers(elements)
        cell_pairs = cell_pairs.sort_by([("a", "ascending"), ("b", "ascending")])
        overlap = [answers.overlap(a, b) for a, b in zip(cell_pairs["a"].to_pylist(), cell_pairs["b"].to_pylist())]
        return cell_pairs.select(["a", "b", "n_a", "n_b"]).append_column("overlap", pa.array(overlap, pa.int64()))

    answered = sent.groupBy("cell").cogroup(placed.groupBy("cell")).applyInArrow(answer, "a long, b long, n_a int, n_b int, overlap long")
    overlaps = stage(answered, "jaccard-overlaps")
    discard(degrees, homes, parts, placed, visits)
    return overlaps


def _leaders(entries: DataFrame, weights: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Pairs of each set with the leaders with which it shares the most lists."""
    placed = entries.join(weights, "set_id")
    placed = placed.join(roots, "set_id", "left").withColumn("root", F.coalesce("root", "set_id")) if roots else placed.withColumn("root", F.col("set_id"))
    best = F.max_by(F.struct("set_id", "n", "reach", "root"), F.struct("weight", "set_id")).alias("best")
    leaders = placed.groupBy("element").agg(best).select("element", F.col("best.set_id").alias("leader"), F.col("best.n").alias("leader_n"), F.col("best.reach").alias("leader_reach"), F.col("best.root").alias("leader_root"))
    return (
        placed.join(leaders, "element")
        .filter("root <> leader_root AND leader_n <= reach AND n <= leader_reach")
        .groupBy("set_id", "n", "leader", "leader_n")
        .agg(F.count("*").alias("shared"))
        .groupBy("set_id", "n")
        .agg(F.slice(F.sort_array(F.collect_list(F.struct("shared", "leader", "leader_n")), asc=False), 1, LEADERS).alias("leaders"))
        .select("set_id", "n", F.explode("leaders").alias("l"))
        .select(F.least("set_id", "l.leader").alias("a"), F.greatest("set_id", "l.leader").alias("b"), F.when(F.col("set_id") < F.col("l.leader"), F.col("n")).otherwise(F.col("l.leader_n")).alias("n_a"), F.when(F.col("set_id") < F.col("l.leader"), F.col("l.leader_n")).otherwise(F.col("n")).alias("n_b"))
        .distinct()
    )


def _meetings(entries: DataFrame, roots: DataFrame, answers: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets, not yet in one component, that an index list and the known answers allow."""
    placed = entries.join(roots, "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    placed = placed.withColumn("block", F.floor(BLOCKS * F.log("n") / math.log(100 / percent)).cast("int"))
    placed = stage(placed, "jaccard-placed")
    mixed = placed.groupBy("element").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("element")
    mixed = stage(mixed, "jaccard-mixed")
    rest = placed.join(small_side(mixed, BROADCAST_NUMBERS), "element", "left_semi")
    # of its answers a set keeps the one with the most in common: who, what it lacks of it, what it has beside it
    known = lambda x, y: answers.select(F.col(x).alias("set_id"), F.struct("overlap", F.col(y).alias("leader"), (F.col(f"n_{y}") - F.col("overlap")).alias("lacks"), (F.col(f"n_{x}") - F.col("overlap")).alias("beside")).alias("answer"))
    best = known("a", "b").unionByName(known("b", "a")).groupBy("set_id").agg(F.max("answer").alias("answer"))
    rest = stage(rest.join(small_side(best, BROADCAST_ROWS), "set_id", "left"), "jaccard-rest")
    # blocks of a list by component, with their bounds; an entry visits those with sets as large as its own or larger
    blocks = rest.groupBy("element", "block", "root").agg(F.min("n").alias("least"), F.max("n").alias("largest"), F.max("reach").alias("most"))
    last = F.floor(BLOCKS * F.log("reach") / math.log(100 / percent)).cast("int")
    visits = rest.filter("reach >= n").select("element", *(F.col(c).alias(f"a_{c}") for c in ("set_id", "n", "reach", "root", "answer")), F.explode(F.sequence("block", F.greatest("block", last))).alias("block"))
    visits = visits.join(blocks, ["element", "block"]).filter("a_root <> root AND least <= a_reach AND largest >= a_n AND a_n <= most").drop("least", "largest", "most")
    partners = rest.select("element", "block", "root", *(F.col(c).alias(f"b_{c}") for c in ("set_id", "n", "reach", "answer")))
    later = (F.col("a_n") < F.col("b_n")) | ((F.col("a_n") == F.col("b_n")) & (F.col("a_set_id") < F.col("b_set_id")))
    common = F.col("a_n") - F.col("a_answer.beside") + F.col("a_answer.lacks")  # the common leader's size
    most = common - F.greatest("a_answer.lacks", "b_answer.lacks") + F.least("a_answer.beside", "b_answer.beside")
    skipped = (F.col("a_answer.leader") == F.col("b_answer.leader")) & ~_enough(most, F.col("a_n"), F.col("b_n"), percent)
    met = visits.join(partners, ["element", "block", "root"]).filter(later & (F.col("b_n") <= F.col("a_reach")) & (F.col("a_n") <= F.col("b_reach")) & ~F.coalesce(skipped, F.lit(False)))
    pairs = stage(met.select(F.col("a_set_id").alias("a"), F.col("b_set_id").alias("b"), F.col("a_n").alias("n_a"), F.col("b_n").alias("n_b")).distinct(), "jaccard-pairs")
    discard(placed, mixed, rest)
    return pairs


def _join_classes(sets: DataFrame, percent: int) -> DataFrame:
    """All links that matter for components: (a, b) by set_id."""
    entries = _entries(sets, percent)
    enough = _enough(F.col("overlap"), F.col("n_a"), F.col("n_b"), percent)
    # leaders are the sets that meet the most others
    lengths = stage(entries.groupBy("element").agg(F.count("*").alias("length")), "jaccard-lengths")
    weights = stage(entries.join(small_side(lengths, BROADCAST_ROWS), "element").groupBy("set_id").agg(F.sum("length").alias("weight")), "jaccard-weights")
    answers, roots = None, None
    for _ in range(LEADER_ROUNDS):
        found = _overlaps(sets, stage(_leaders(entries, small_side(weights, BROADCAST_ROWS), roots), "jaccard-likely"))
        answers = answers.unionByName(found) if answers else found
        roots = small_side(components(answers.filter(enough).select("a", "b")).withColumnRenamed("node", "set_id"), BROADCAST_ROWS)
    last = _overlaps(sets, _meetings(entries, roots, answers, percent))
    discard(entries, lengths, weights)
    return answers.unionByName(last).filter(enough).select("a", "b")


def jaccard_components(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """Per document row: doc_id, text_key (xxhash64 of the text), n_shingles, component_id,
    set_id and class_doc (the least doc_id with an equal set)."""
    posted = stage(_digests(docs, width, percent), "jaccard-digests")
    suspects, digests = _suspects(posted, percent), stage(posted.drop("first"), "jaccard-rows")
    discard(posted)
    sets = _sets(docs, suspects, width)
    roots = components(_join_classes(sets, percent))
    discard(suspects, sets)
    classes = digests.filter("n > 0").groupBy("set_id", "n").agg(F.min("doc_id").alias("class_doc"))
    rooted = stage(classes.join(roots.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("root", F.coalesce("root", "set_id")), "jaccard-rooted")
    least = rooted.groupBy("root").agg(F.min("class_doc").alias("component_id"))
    named = stage(rooted.join(least, "root").select("set_id", "n", "root", "class_doc", "component_id"), "jaccard-named")
    return digests.join(named, ["set_id", "n"], "left").select(
        "doc_id",
        "text_key",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("class_doc", "doc_id").alias("class_doc"),
        "root",
    )


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_shingles", "component_id")


ORACLE_OP4 = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - 3, 1) + 1), lambda i: md5(array_to_string(w[i:i + 3], ' ')))) END AS shingles FROM t
), e AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, (SELECT min(b) FROM reach WHERE a = doc_id) AS component_id FROM s
"""
