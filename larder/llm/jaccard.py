"""N-gram Jaccard self-join by vertical partitioning of the global n-gram order.

After Rong and others (Fast and scalable distributed set similarity joins for
big data analytics, 2017): all n-grams stand in one global order, frequent ones
last, and the order is cut into fragments. A candidate pair's overlap is counted
in each fragment apart, and the partial counts are summed per pair, so no row
and no task needs two whole sets, and long documents are split like any other.

1. Documents with equal sets are one class; only class representatives go on.
2. Two sets of similarity t share an n-gram among the first n - ceil(t n) + 1 of
   each (in any fixed order). These prefixes meet by n-gram, with the usual
   length and position filters.
   The shorter set's prefix is shorter still: n - ceil(2 t n / (1 + t)) + 1.
   Before the counting, 512 parities a document (each n-gram flips one cell) give
   a lower bound on how far two sets differ; pairs beyond what t allows go.
3. Only components are asked for, so pairs inside a component need no look. In a
   round, each n-gram's documents meet `hubs` of them, the least by a hash each,
   so that n-grams of the same documents choose the same. A document's nearest hub
   outside its component by the parities is verified, links are contracted, and
   the next round has other hubs, as long as that finds links. Then, for each n-gram, documents outside its largest
   component meet all others of the n-gram. No link between components can be
   lost, and a group of copies costs its size, not its square.

The order goes by the counts of n-grams that are frequent anywhere, from one pass
over all documents, held to the `hot` most frequent, and then by hash. Any fixed
order gives the same result; this one keeps common passages out of the prefixes.
Half of the fragments divide the n-grams without such a count, half those with
one, so that each has an equal share.

n-grams are compared as 64-bit hashes. A text with fewer than n words is one
n-gram, its whole sequence; null, empty and blank texts have an empty set and
link with nothing. Rows with equal ids are told apart by their texts. Extra
columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.components import connected
from larder.llm.scratch import Scratch
from larder.llm.text import WordHashes, gram_hashes, hashed, lean, portions, texts


def gram_sets(some: list[bytes], n: int, hashes: WordHashes) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's n-grams of lower-cased words."""
    h, starts = hashed(some, hashes, lower=True)
    grams = gram_hashes(h, n)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if b - a >= n:
            s = np.sort(grams[a : b - n + 1])
            yield s[np.concatenate(([True], s[1:] != s[:-1]))]
        elif b > a:
            yield gram_hashes(h[a:b], b - a) ^ np.uint64(b - a)
        else:
            yield np.empty(0, np.uint64)


#: Cells of the parity filter: two sets differ in at least as many n-grams as their parities do in cells.
BITS = 512
#: Rows of three numbers that are broadcast to find their texts; with more, texts are shuffled.
SENT = 100_000
#: n-grams that a task counts at a time.
COUNTED = 1_000_000


def _frequent(documents: DataFrame, n: int, text: str, hot: int) -> tuple[np.ndarray, np.ndarray]:
    """n-grams that some stretch of the documents repeats, with the sum of those counts; the `hot` most frequent."""

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, size = WordHashes(), [], 0

        def repeated():
            grams, counts = np.unique(np.concatenate(held), return_counts=True)
            many = counts > 1
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(grams[many].view(np.int64)), pa.array(counts[many].astype(np.int64))], names=["gram", "n"]
            )

        for batch in portions(batches, text):
            sets = list(gram_sets(texts(batch, text), n, hashes))
            held += sets
            size += sum(map(len, sets))
            if size >= COUNTED:
                yield repeated()
                size = 0
        if held:
            yield repeated()

    got = (
        documents.select(text)
        .mapInArrow(count, "gram long, n long")
        .groupBy("gram")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.col("n").desc(), "gram")
        .limit(hot)
        .toArrow()
    )
    grams = got["gram"].to_numpy().view(np.uint64)
    order = np.argsort(grams)
    return grams[order], got["n"].to_numpy()[order]


class Order:
    """The global order: n-grams without a count by hash, then the counted ones, the rarest first; and its fragments."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, fragments: int):
        self.grams, self.counts = grams, counts
        self.many = many = fragments // 2 if len(grams) else 0
        self.rare = fragments - many
        self.hash_cuts = np.array([k * ((1 << 64) // self.rare) for k in range(1, self.rare)], np.uint64)
        by_count = np.sort(counts)
        share = np.cumsum(by_count)
        self.count_cuts = by_count[np.searchsorted(share, [share[-1] * k // many for k in range(1, many)])] if many else by_count[:0]

    def count(self, s: np.ndarray) -> np.ndarray:
        if not len(self.grams):
            return np.zeros(len(s), np.int64)
        at = np.minimum(np.searchsorted(self.grams, s), len(self.grams) - 1)
        return np.where(self.grams[at] == s, self.counts[at], 0)

    def sort(self, s: np.ndarray) -> np.ndarray:
        return s[np.lexsort((s, self.count(s)))]

    def split(self, s: np.ndarray) -> list[np.ndarray]:
        """A set cut into its parts in each fragment."""
        n = self.count(s)
        at = np.searchsorted(self.hash_cuts, s, "right")
        if self.many:
            at = np.where(n > 0, self.rare + np.searchsorted(self.count_cuts, n), at)
        order = np.argsort(at, kind="stable")
        return np.split(s[order], np.searchsorted(at[order], np.arange(1, self.rare + self.many)))


def _prefixes(documents: DataFrame, n: int, percent: int, text: str, order) -> DataFrame:
    """(doc_id, text_key, n, set_key, bits, prefix) of each document; bits: parities of the n-grams dealt to BITS cells."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in portions(batches, "_text"):
            sizes, keys, prefixes, bits = [], [], [], []
            for s in gram_sets(texts(batch, "_text"), n, hashes):
                sizes.append(len(s))
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                parity = np.bincount((s & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
                bits.append(np.packbits(parity.astype(np.uint8)).view(np.int64))
                prefixes.append(order.value.sort(s)[: len(s) - -(-percent * len(s) // 100) + 1].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(bits, pa.list_(pa.int64())),
                    pa.array(prefixes, pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_key", "n", "set_key", "bits", "prefix"],
            )

    return documents.select("doc_id", F.xxhash64(text).alias("text_key"), F.col(text).alias("_text")).mapInArrow(
        run, "doc_id long, text_key long, n long, set_key binary, bits array<long>, prefix array<long>"
    )


def _segments(documents: DataFrame, n: int, text: str, order) -> DataFrame:
    """(c, fragment, grams): each document's set, cut at the borders of the order's fragments."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()
        for batch in portions(batches, text, 1 << 20):
            cs, at, grams = [], [], []
            for c, s in zip(batch.column("c").to_pylist(), gram_sets(texts(batch, text), n, hashes)):
                if c in seen:  # a row alike in id and text
                    continue
                seen.add(c)
                for k, part in enumerate(order.value.split(s)):
                    cs.append(c)
                    at.append(k)
                    grams.append(part.view(np.int64))
            if cs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cs, pa.int64()), pa.array(at, pa.int32()), pa.array(grams, pa.list_(pa.int64()))],
                    names=["c", "fragment", "grams"],
                )

    return documents.select("c", text).mapInArrow(run, "c long, fragment int, grams array<long>")


def near_duplicates(
    documents: DataFrame,
    *,
    n: int = 5,
    percent: int = 80,
    fragments: int = 4,
    hot: int = 500_000,
    rounds: int = 4,
    hubs: int = 8,
    text: str = "text",
) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id) of every row; text_key is xxhash64 of the text.

    Documents link when 100 * |intersection| >= percent * |union|.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark)
    documents, text = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")), "text"
    # at most `hot` n-grams of 16 bytes
    order = spark.sparkContext.broadcast(Order(*_frequent(documents, n, text, hot), fragments))
    whole = scratch.keep(_prefixes(documents, n, percent, text, order).withColumn("row", F.monotonically_increasing_id()))
    sets = scratch.keep(whole.drop("prefix", "bits"))
    # a class is known by its first row; copies combine before the shuffle, and what the class needs comes along
    first = F.min(F.struct(F.col("row").alias("c"), "doc_id", "text_key", "n", "bits", "prefix")).alias("first")
    reps = scratch.keep(whole.where("n > 0").groupBy("set_key").agg(first, F.min("doc_id").alias("least_id")).select("set_key", "least_id", "first.*"))
    scratch.drop(whole)
    classes = scratch.keep(reps.select("set_key", "c", "least_id", "n"))
    keys = scratch.keep(reps.select("c", "doc_id", "text_key", "n", "bits"))
    posts = reps.select("c", F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("pos", "gram"))
    # an n-gram counts if it is in the short prefix of a document, and in another's prefix
    own = (100 + percent) * (F.col("n") - F.col("pos")) >= 2 * percent * F.col("n")
    # one number: documents in the low half, those with it in their short prefix in the high half
    shared = posts.groupBy("gram").agg(F.sum(F.when(own, (1 << 32) + 1).otherwise(1)).alias("k")).where(f"k % {1 << 32} > 1 and k > {1 << 32}")
    posts = scratch.keep(posts.join(shared.select("gram").hint("merge"), "gram", "left_semi"))
    scratch.drop(reps)

    def may_link(a: str, b: str):
        """a is no longer than b: length filter, a's own prefix, and the position filter for a first common n-gram."""
        na, nb, at = F.col(f"{a}.n"), F.col(f"{b}.n"), F.col(f"{a}.pos")
        left = F.least(na - at, nb - F.col(f"{b}.pos"))
        own = (100 + percent) * (na - at) >= 2 * percent * na
        return (100 * na >= percent * nb) & own & (left * (100 + percent) >= percent * (na + nb))

    def differ(a: str, b: str):
        return sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(BITS // 64)), F.lit(0))

    def near(a: str, b: str, na: str, nb: str):
        """Whether the parities leave room for a link."""
        return differ(a, b) * (100 + percent) <= (F.col(na) + F.col(nb)) * (100 - percent)

    def pairs_of(*found: DataFrame) -> DataFrame:
        out = found[0]
        for x in found[1:]:
            out = out.union(x)
        return out.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def segments_of(pairs: DataFrame) -> DataFrame:
        asked = pairs.select(F.col("a").alias("c")).union(pairs.select(F.col("b").alias("c"))).distinct()
        wanted = scratch.keep(keys.join(asked, "c", "left_semi").select("c", F.col("doc_id").alias("_d"), F.col("text_key").alias("_k")))
        if wanted.count() <= SENT:
            wanted = F.broadcast(wanted)
        found = documents.withColumn("_t", F.xxhash64(text)).join(
            wanted, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_t") == F.col("_k"))
        )
        return _segments(found.select("c", text), n, text, order)

    def may_pass(pairs: DataFrame) -> DataFrame:
        """Pairs whose parities leave room for a link, with the sets' sizes and the number of cells that differ."""
        of = lambda x: keys.select(F.col("c").alias(x), F.col("n").alias(f"n{x}"), F.col("bits").alias(f"bits_{x}"))
        return (
            pairs.join(of("a"), "a")
            .join(of("b"), "b")
            .where(near("bits_a", "bits_b", "na", "nb"))
            .withColumn("differ", differ("bits_a", "bits_b"))
            .drop("bits_a", "bits_b")
        )

    def verified(pairs: DataFrame) -> DataFrame:
        """Pairs that link: partial overlaps counted fragment by fragment, and summed.

        After each fragment a pair goes if what is left of the shorter set cannot make up the rest.
        """
        open_ = scratch.keep(
            pairs.select("a", "b", "na", "nb", F.col("na").alias("left_a"), F.col("nb").alias("left_b"), F.lit(0).cast("long").alias("common"))
        )
        segments = scratch.keep(segments_of(open_), partition_by="fragment")
        for k in range(fragments):
            part = segments.where(F.col("fragment") == k).select("c", "grams")
            a = part.select(F.col("c").alias("a"), F.col("grams").alias("grams_a"))
            b = part.select(F.col("c").alias("b"), F.col("grams").alias("grams_b"))
            counted = open_.join(a, "a").join(b, "b").select(
                "a", "b", "na", "nb", (F.col("left_a") - F.size("grams_a")).alias("left_a"), (F.col("left_b") - F.size("grams_b")).alias("left_b"),
                (F.col("common") + F.size(F.array_intersect("grams_a", "grams_b"))).alias("common"),
            )
            most = F.col("common") + F.least("left_a", "left_b")
            # rows alike in id and text may bring a segment from several tasks
            after = scratch.keep(counted.where(most * (100 + percent) >= percent * (F.col("na") + F.col("nb"))).distinct())
            scratch.drop(open_)
            open_ = after
        links = scratch.keep(open_.select("a", "b"))
        scratch.drop(segments, open_)
        return links

    def either(a: str, b: str):
        """may_link, whichever is the shorter."""
        return F.when(F.struct(f"{a}.n", f"{a}.c") < F.struct(f"{b}.n", f"{b}.c"), may_link(a, b)).otherwise(may_link(b, a))

    component = tried = links = None
    kept_posts = posts
    found, me = True, F.struct("c", "n", "pos", "component")
    for k in range(rounds + 1):
        last = k == rounds or not found
        if component is None:
            marked = posts.withColumn("component", F.col("c"))
        else:
            marked = posts.join(component, posts["c"] == component["node"], "left").select(
                "gram", "c", "n", "pos", F.coalesce("component", "c").alias("component")
            )
            mixed = marked.groupBy("gram").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
            marked = scratch.keep(marked.join(mixed.select("gram"), "gram", "left_semi"))
            scratch.drop(kept_posts)
            kept_posts = marked
        if last:
            # an n-gram's largest component needs no look at itself; only what may link leaves this join
            parts = marked.groupBy("gram", "component").agg(F.count("*").alias("size"))
            largest = parts.groupBy("gram").agg(F.max(F.struct("size", "component"))["component"].alias("largest"))
            dealt = marked.join(largest, "gram").withColumn("apart", F.col("component") != F.col("largest"))
            dealt = scratch.keep(
                dealt.join(keys.select("c", "bits"), "c").select("gram", F.struct("c", "n", "pos", "component", "bits", "apart").alias("x"))
            )
            x, y = dealt.where("x.apart"), dealt.withColumnRenamed("x", "y")
            apart = x.join(
                y.hint("merge"),
                (x["gram"] == y["gram"])
                & (F.col("x.component") != F.col("y.component"))
                & (~F.col("y.apart") | (F.col("x.c") < F.col("y.c")))
                & either("x", "y")
                & near("x.bits", "y.bits", "x.n", "y.n"),
            )
            new = pairs_of(apart.select(F.col("x.c").alias("a"), F.col("y.c").alias("b")))
        else:
            pick = [F.min(F.struct(F.xxhash64("c", F.lit(k * hubs + j)).alias("h"), "c", "n", "pos", "component")).alias(f"h{j}") for j in range(hubs)]
            chosen = marked.groupBy("gram").agg(*pick).select("gram", F.array(*[f"h{j}" for j in range(hubs)]).alias("hubs"))
            met = marked.select("gram", me.alias("me")).join(chosen, "gram").select("me", F.explode(F.array_distinct("hubs")).alias("hub"))
            met = met.where("hub.component <> me.component").where(either("hub", "me"))
            met = met.select(F.col("me.c").alias("c"), F.col("hub.c").alias("o")).distinct()
            new = met.withColumns({"a": F.least("c", "o"), "b": F.greatest("c", "o")})
        # kept first: so few pairs that the sets' keys need no shuffle
        asked = scratch.keep(new.join(tried, ["a", "b"], "left_anti") if tried is not None else new)
        new = may_pass(asked)
        if not last:
            new = new.groupBy("c").agg(F.min_by(F.struct("a", "b", "na", "nb"), F.struct("differ", "o")).alias("best")).select("best.*").distinct()
        new = scratch.keep(new.select("a", "b", "na", "nb"))
        scratch.drop(asked)
        posts, found = marked.select("gram", "c", "n", "pos"), False
        if not new.isEmpty():
            asked = new.select("a", "b")
            tried = scratch.keep(tried.union(asked)) if tried is not None else asked
            more = verified(new)
            found = not more.isEmpty()
        if found:
            links = scratch.keep(links.union(more)) if links is not None else more
            component = scratch.keep(connected(links, scratch))
        if last:
            break
    order.destroy()
    scratch.keep_only(sets, classes, *([] if component is None else [component]))
    if component is None:
        component = spark.createDataFrame([], "node long, component long")
    named = classes.join(component, classes["c"] == component["node"], "left").withColumn(
        "component", F.coalesce("component", "c")
    )
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = named.join(least, "component").select("set_key", "component_id")
    return (
        sets.select("doc_id", "text_key", "n", "set_key")
        .join(named, "set_key", "left")
        .select(
            "doc_id",
            "text_key",
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        )
    )
