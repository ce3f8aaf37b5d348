"""MinHash near-dedup: chosen-path set similarity join.

A document's set holds its distinct 2-word shingles (words are runs of anything
but ``\\x20 \\x09-\\x0D``, A-Z lower-cased; a text of one word is one shingle).
Documents of equal sets form one class and only its smallest id goes on. Every
class follows one path down each of ``TREES`` independent trees: at each step it
branches on the minwise token of its set under the step's hash, so two classes of
similarity s are together after k steps with chance s**k. Nodes are looked at
after each depth of ``DEPTHS``; a node of at most ``SMALL`` classes is compared
exhaustively, a larger one branches on and has leaders (the first under ``LEADERS``
orders, two of them by a hash that the node's key seeds). First every class of large
nodes tries the two first leaders it meets most often, which connects groups of
many near copies by at most two candidates a member. Then pairs are made only of classes that
are not connected: in small nodes, among leaders, and of a class connected to none with at most ``TRIED`` leaders.

What this leaves unconnected in the large nodes of the first depth goes through
an exact join: of two sets alike by the threshold, each holds the first common item
of any fixed order so early that the items left after it can make up the overlap.
The order is by rising count, so the items that a group's template brings stand last;
items whose classes are all connected already are left out, for they link nothing.

At similarity 0.8 a pair shares no depth-2 node of 12 trees with chance
0.36**12 = 5e-6, whatever the nodes' sizes. Signature estimates drop only candidates four deviations
below the threshold. Links are confirmed on the full sets in rounds: each component
tries its likeliest candidates to other components, and components contract, so a
group of many near copies needs few confirmed links a member.

Defined results: null and empty texts have an empty set, are linked with nothing
and are kept; repeated rows are one class; rows of one id share its component; a
null id is in no class, its component is null and it is kept; an empty table gives an
empty result; further columns are ignored by ``components`` and carried by
``keep_first``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import map_docs, prepare
from blotter.session import materialize

TREES = 12
DEPTHS = (2, 4, 8)
SMALL = 24
LEADERS = 4
#: Leaders that a class connected to none tries.
TRIED = 16
SLACK = 0.16  # four deviations of an estimate from 128 values
SIGNATURE = 128
MEMO_WORDS = 400_000
SALTS = 16
#: Counters of the items in large nodes, by the items' last bits; they only order the items.
COUNTERS = 1 << 18
#: Rows of one item that a share of its pairs is dealt by.
ITEM_ROWS = 2_000

_RNG = np.random.default_rng(3)
_A = (_RNG.integers(0, 2**31, SIGNATURE) * 2 + 1).astype(np.uint32)
_B = _RNG.integers(0, 2**32, SIGNATURE).astype(np.uint32)
_P = np.uint64(0x9E3779B97F4A7C15)


class WordHash(dict):
    """64-bit hash of each word, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))


def shingles(text: str | None, width: int, memo: WordHash) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's ``width``-word shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    ids = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    width = min(width, len(ids))
    out = np.full(len(ids) - width + 1, width, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            out = _mix(out * _P + ids[k : len(ids) - width + 1 + k])
    return np.unique(out)


def signature(items: np.ndarray) -> np.ndarray:
    """Minwise value of the set under each of ``SIGNATURE`` hashes."""
    best = np.full(SIGNATURE, 2**32 - 1, np.uint32)
    x = (items >> np.uint64(32)).astype(np.uint32)
    with np.errstate(over="ignore"):
        for a in range(0, len(x), 2048):
            np.minimum(best, (x[a : a + 2048, None] * _A + _B).min(axis=0), out=best)
    return best


def node_keys(sig: np.ndarray) -> list[int]:
    """The nodes on a set's paths: for every tree one key per depth."""
    steps = SIGNATURE // TREES if SIGNATURE // TREES >= DEPTHS[-1] else DEPTHS[-1]
    keys = []
    for t in range(TREES):
        path = sig[t * steps : t * steps + DEPTHS[-1]].tobytes()
        keys += [
            xxhash.xxh3_64_intdigest(path[: 4 * d], seed=t * 16 + d) - 2**63 for d in DEPTHS
        ]
    return keys


def _features(docs: DataFrame, text_col: str, width: int) -> DataFrame:
    def rows(memo, ids, texts):
        n, print_, sig, keys = [], [], [], []
        for t in texts:
            s = shingles(t, width, memo)
            n.append(len(s))
            print_.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
            m = signature(s)
            sig.append((m & np.uint32(0xFFFF)).astype(np.uint16).tobytes())
            keys.append(node_keys(m) if len(s) else [])
        return {"n": n, "print": print_, "sig": sig, "keys": keys}

    kind = dict(docs.dtypes)["doc_id"]
    return map_docs(
        docs, ["doc_id", text_col], rows, f"doc_id {kind}, n bigint, print binary, sig binary, keys array<bigint>", WordHash
    )


def _places(classes: DataFrame) -> DataFrame:
    """Every class at each node of its paths that it shares, with the node's number of classes."""
    at = classes.select("id", "n", F.posexplode("keys").alias("pos", "key")).select(
        "id", "n", "key", (F.col("pos") % len(DEPTHS)).cast("tinyint").alias("level")
    )
    sizes = materialize(at.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
    return materialize(at.join(sizes, "key"))


def _fits(x: Column, y: Column) -> Column:
    """Whether two sets' sizes leave room for the least threshold in use."""
    return (10 * F.least(x["n"], y["n"]) >= 8 * F.greatest(x["n"], y["n"])) & (x["id"] != y["id"])


def _labelled(places: DataFrame, label: DataFrame) -> DataFrame:
    """The places as (key, size, level, x), x holding the class's id, n, label and whether it is connected to none yet."""
    found = label.select("id", F.col("label").alias("_l"))
    x = F.struct("id", "n", F.coalesce("_l", "id").alias("label"), F.col("_l").isNull().alias("alone"))
    return places.join(found, "id", "left").select("key", "size", "level", x.alias("x"))


def _leaders(large: DataFrame) -> DataFrame:
    """The leaders l0, l1, .. of the large nodes whose classes are not all connected."""
    seeded = F.struct(F.xxhash64("x.id", "key").alias("by"), "x")
    first = large.groupBy("key").agg(
        F.min("x.label").alias("low"),
        F.max("x.label").alias("high"),
        F.min(F.struct(F.col("x.id").alias("by"), "x")).alias("l0"),
        F.min(seeded).alias("l1"),
        F.max(seeded).alias("l2"),
        F.max(F.struct(F.col("x.n").alias("by"), "x")).alias("l3"),
    )
    return materialize(first.where("low <> high").select("key", *[F.col(f"l{i}.x").alias(f"l{i}") for i in range(LEADERS)]))


def _met(large: DataFrame, leaders: DataFrame) -> DataFrame:
    """The classes x of large nodes beside their leaders; salted over the leaders' copies."""
    salted = leaders.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return large.withColumn("salt", F.pmod(F.xxhash64("x.id"), F.lit(SALTS)).cast("int")).join(salted, ["key", "salt"])


def _pairs(ends: DataFrame) -> DataFrame:
    return ends.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()


def _often(ends: DataFrame, most: int) -> DataFrame:
    """Of a class's ways (p, q) the ``most`` to the leaders that it meets in most nodes."""
    ways = ends.groupBy("p", "q").agg((-F.count(F.lit(1))).alias("by"))
    ways = ways.groupBy("p").agg(F.sort_array(F.collect_list(F.struct("by", "q"))).alias("ways"))
    return ways.select("p", F.explode(F.slice("ways", 1, most)).alias("way")).select("p", "way.q")


def _first_candidates(places: DataFrame, label: DataFrame) -> DataFrame:
    """Two pairs (a < b) at most for each class of a large node: with the first leaders that it meets most often."""
    large = _labelled(places.where(F.col("size") > SMALL), label)
    ends = _met(large, _leaders(large)).where(_fits(F.col("x"), F.col("l0")))
    return _pairs(_often(ends.select(F.col("x.id").alias("p"), F.col("l0.id").alias("q")), 2))


def _candidates(places: DataFrame, label: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) of classes not connected yet, of sizes that fit the threshold: all that meet in a
    small node; of large nodes the leaders among themselves, and each class connected to none with
    the leaders that it meets most often. What large nodes leave apart is for ``_exact``."""
    at = _labelled(places, label)

    def fit(x: Column, ys: Column) -> Column:
        return F.transform(F.filter(ys, lambda y: _fits(x, y) & (x["label"] != y["label"])), lambda y: y["id"])

    # exhaustive comparison in small nodes; at most SMALL classes a list
    small = (
        at.where(F.col("size") <= SMALL)
        .groupBy("key")
        .agg(F.sort_array(F.collect_list("x")).alias("m"), F.min("x.label").alias("low"), F.max("x.label").alias("high"))
        .where("low <> high")
        .select(F.posexplode("m").alias("i", "x"), "m")
        .select(F.col("x.id").alias("p"), F.explode(fit(F.col("x"), F.slice("m", F.col("i") + 2, SMALL))).alias("q"))
    )
    large = at.where(F.col("size") > SMALL)
    leaders = _leaders(large)
    among = leaders.select(F.array(*[f"l{i}" for i in range(LEADERS)]).alias("m"))
    among = among.select(F.explode("m").alias("x"), "m").select(F.col("x.id").alias("p"), F.explode(fit(F.col("x"), F.col("m"))).alias("q"))
    star = _met(large.where("x.alone"), leaders).select(
        F.col("x.id").alias("p"), F.explode(fit(F.col("x"), F.array_distinct(F.array(*[f"l{i}" for i in range(LEADERS)])))).alias("q")
    )
    return _pairs(small.union(among).union(_often(star, TRIED)))


def _unsettled(places: DataFrame, label: DataFrame) -> DataFrame:
    """Distinct (doc_id, label) of the classes that share a large node of the first depth with a
    class they are not connected to."""
    at = _labelled(places.where((F.col("size") > SMALL) & (F.col("level") == 0)), label)
    at = materialize(at.select("x.id", "key", "x.label"))
    mixed = at.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("key")
    return materialize(at.join(mixed, "key", "left_semi").select(F.col("id").alias("doc_id"), "label").distinct())


def _counts(sets: DataFrame) -> np.ndarray:
    """How many sets hold an item of each counter, summed by Spark."""

    def run(batches):
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            items = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint64)
            total += np.bincount((items & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["at", "k"])

    got = sets.select("items").mapInArrow(run, "at bigint, k bigint").groupBy("at").agg(F.sum("k").alias("k")).toArrow()
    out = np.zeros(COUNTERS, np.int64)
    out[got["at"].to_numpy()] = got["k"].to_numpy()
    return out


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """Each set's first items under the order by count, and how many items are left from each on:
    as many as can hold the first common item with a set alike by ``percent``."""
    counts = _counts(sets)
    kind = dict(sets.dtypes)["doc_id"]

    def rows(_, ids, labels, items):
        n, first = [], []
        for x in items:
            x = np.frombuffer(x, np.uint64)
            x = x[np.lexsort((x, counts[x & np.uint64(COUNTERS - 1)]))]
            n.append(len(x))
            first.append(x[: len(x) - -(-percent * len(x) // 100) + 1].view(np.int64).tolist())
        return {"label": labels, "n": n, "first": first}

    got = map_docs(
        sets, ["doc_id", "label", "items"], rows, f"doc_id {kind}, label {kind}, n bigint, first array<bigint>"
    )
    return got.select(F.col("doc_id").alias("id"), "label", "n", F.posexplode("first").alias("pos", "item")).select(
        "id", "label", "n", (F.col("n") - F.col("pos")).alias("left"), "item"
    )


def _exact(sets: DataFrame, percent: int) -> DataFrame:
    """All pairs (a < b) of unconnected sets whose first common item leaves room for an overlap of
    ``percent``. Distinct; a hot item's pairs are dealt out by one end's hash."""
    at = materialize(_prefixes(sets, percent))
    # an item all of whose classes are connected links nothing
    items = at.groupBy("item").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("size"))
    items = items.where("low <> high").select("item", F.ceil(F.col("size") / ITEM_ROWS).cast("int").alias("shares"))
    at = materialize(at.join(items, "item"))
    x = at.select("item", F.pmod(F.xxhash64("id"), "shares").cast("int").alias("share"), F.struct("id", "label", "n", "left").alias("x"))
    y = at.select("item", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.struct("id", "label", "n", "left").alias("y"))
    room = (100 + percent) * F.least("x.left", "y.left") >= percent * (F.col("x.n") + F.col("y.n"))
    return (
        x.join(y, ["item", "share"])
        .where((F.col("x.id") < F.col("y.id")) & (F.col("x.label") != F.col("y.label")) & room)
        .select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
        .distinct()
    )


def _estimates(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """The pairs whose signatures do not rule them out, with the estimate. The pairs are written first, so
    that few of them are broadcast and no signature is shuffled."""
    pairs = materialize(pairs)
    sig = classes.select("id", "sig")
    both = pairs.join(sig.toDF("a", "sa"), "a").join(sig.toDF("b", "sb"), "b")

    def rows(_, a, b, sa, sb):
        x = np.frombuffer(b"".join(sa), np.uint16).reshape(len(a), SIGNATURE)
        y = np.frombuffer(b"".join(sb), np.uint16).reshape(len(a), SIGNATURE)
        return {"b": b, "est": (x == y).mean(axis=1).tolist()}

    kind = dict(pairs.dtypes)["a"]
    return map_docs(both, ["a", "b", "sa", "sb"], rows, f"a {kind}, b {kind}, est double").where(F.col("est") >= least)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, la, lb), each with ``ok``: whether full sets of its ends are alike by ``percent``.
    Distinct; an id of several sets may give a pair both verdicts, and one that is true counts."""
    both = pairs.join(sets.toDF("a", "sa"), "a", "left").join(sets.toDF("b", "sb"), "b", "left")

    def rows(_, a, b, la, lb, sa, sb):
        ok = []
        for x, y in zip(sa, sb):
            x, y = np.frombuffer(x or b"", np.uint64), np.frombuffer(y or b"", np.uint64)
            inter = len(np.intersect1d(x, y, assume_unique=True))
            ok.append(inter > 0 and 100 * inter >= percent * (len(x) + len(y) - inter))
        return {"b": b, "la": la, "lb": lb, "ok": ok}

    kind = dict(pairs.dtypes)["a"]
    schema = f"a {kind}, b {kind}, la {kind}, lb {kind}, ok boolean"
    return map_docs(both, ["a", "b", "la", "lb", "sa", "sb"], rows, schema).distinct()


def connected(edges: DataFrame, most: int | None = None) -> DataFrame:
    """(id, label): the smallest id reachable over the edges, of which there are at most ``most``, for every id on one.

    Each round takes the smallest label around and then jumps to the label's
    own label; every round is written out, so lineage stays short."""
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct()
    both = materialize(both, most if most is None else 2 * most)
    most = both.count()
    labels = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "id")
    labels = materialize(labels, most)
    while True:
        near = (
            both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("label").alias("near"))
        )
        step = labels.join(near, labels["id"] == near["a"], "left").select(
            "id", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        jump = step.select(F.col("id").alias("label"), F.col("label").alias("far"))
        step = materialize(
            step.join(jump, "label", "left").select("id", "old", F.least("label", "far").alias("label")), most
        )
        labels = step.select("id", "label")
        if step.where("label <> old").isEmpty():
            return labels


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, the set's items and their print."""

    def rows(memo, ids, texts):
        items = [shingles(t, width, memo).tobytes() for t in texts]
        return {"items": items, "print": [hashlib.blake2b(x, digest_size=16).digest() for x in items]}

    kind = dict(docs.dtypes)["doc_id"]
    return map_docs(docs, ["doc_id", "_t"], rows, f"doc_id {kind}, items binary, print binary", WordHash)


def _ends_sets(docs: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """The sets of the pairs' ends. Rows of one id with several texts: the id's set is that of any of them that fits."""
    # written, so that the planner knows its size: while it may be broadcast, no text is shuffled
    ends = materialize(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), 2 * pairs.count())
    return materialize(_sets(docs.join(ends, "doc_id", "left_semi"), width).where(F.length("items") > 0).select("doc_id", "items"))


def _links(pairs: DataFrame, sets: DataFrame, percent: int, label: DataFrame) -> DataFrame:
    """Confirmed pairs that connect all that the candidates, if alike by ``percent``, connect beyond ``label``.

    In rounds: each component of what is confirmed so far deals the candidates that lead out of it to
    ``shares`` groups, and the likeliest of each group is confirmed. Components contract to their labels,
    candidates tried or inside a component go, and ``shares`` grows, so that components whose candidates
    fail, however many these are, try more at once. Once no more candidates are left than were tried, the
    next round tries them all, which at most doubles the work. It ends when no candidate is left."""
    rest = pairs.join(label.toDF("a", "la"), "a", "left").join(label.toDF("b", "lb"), "b", "left")
    rest = rest.select("a", "b", "est", F.coalesce("la", "a").alias("la"), F.coalesce("lb", "b").alias("lb")).where("la <> lb")
    links, shares, spent, left, most = None, 1, 0, None, pairs.count()
    while True:
        ways = rest.select("a", "b", "est", "la", "lb", F.explode(F.array("la", "lb")).alias("own"))
        group = F.pmod(F.xxhash64("a", "b"), F.lit(shares)).alias("group")
        best = ways.groupBy("own", group).agg(F.max(F.struct("est", "a", "b", "la", "lb")).alias("m"))
        best = best.select("m.a", "m.b", "m.la", "m.lb").distinct()
        if left is not None and left <= spent:
            best = rest.select("a", "b", "la", "lb")
        tried = materialize(_confirmed(best, sets, percent), 2 * most)
        done = tried.where("ok").select("a", "b", "la", "lb")
        links = done.select("a", "b") if links is None else links.union(done.select("a", "b"))
        if left is not None and left <= spent:
            return links
        now = tried.count()
        step = connected(done.select(F.col("la").alias("a"), F.col("lb").alias("b")), now)
        rest = (
            rest.join(tried.select("a", "b"), ["a", "b"], "left_anti")
            .join(step.toDF("la", "na"), "la", "left")
            .join(step.toDF("lb", "nb"), "lb", "left")
            .select("a", "b", "est", F.coalesce("na", "la").alias("la"), F.coalesce("nb", "lb").alias("lb"))
            .where("la <> lb")
        )
        rest = materialize(rest, most)
        spent, left = spent + now, rest.count()
        most = left
        if not left:
            return links
        shares *= 4 if shares == 1 else 16


def components(docs: DataFrame, text_col: str = "text", width: int = 2, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row per input row."""
    prepare(docs.sparkSession)
    docs = docs.select("doc_id", F.col(text_col).alias("_t"))
    feats = materialize(_features(docs, "_t", width))
    # equal sets: one class, combined before the shuffle
    classes = materialize(
        feats.where("n > 0 AND doc_id IS NOT NULL")
        .groupBy("print")
        .agg(F.min(F.struct("doc_id", "n", "sig", "keys")).alias("c"))
        .select("print", F.col("c.doc_id").alias("id"), "c.n", "c.sig", "c.keys"),
        feats.count(),
    )
    least = percent / 100 - SLACK
    places = _places(classes)
    # groups of many near copies first, by two candidates a member, so that what is connected is not compared again
    none = classes.select("id", F.col("id").alias("label")).limit(0)
    pairs = materialize(_estimates(_first_candidates(places, none), classes, least))
    tried = pairs.select("a", "b", F.col("a").alias("la"), F.col("b").alias("lb"))
    links = materialize(_confirmed(tried, _ends_sets(docs, pairs, width), percent).where("ok").select("a", "b"))
    label = connected(links)
    pairs = materialize(_estimates(_candidates(places, label), classes, least))
    links = links.union(_links(pairs, _ends_sets(docs, pairs, width), percent, label))
    # what is still apart in large nodes
    label = connected(links)
    apart = _unsettled(places, label)
    if not apart.isEmpty():
        sets = _sets(docs.join(apart, "doc_id", "left_semi"), width).where(F.length("items") > 0)
        sets = materialize(sets.dropDuplicates(["doc_id", "print"]).join(apart, "doc_id"))
        pairs = materialize(_estimates(_exact(sets, percent), classes, least))
        links = links.union(_links(pairs, sets.select("doc_id", "items"), percent, label))
    # ids that stand for several classes (one id, several texts) tie these together
    member = feats.where("n > 0 AND doc_id IS NOT NULL").select("doc_id", "print").join(
        classes.select("print", "id"), "print"
    )
    ties = member.where("doc_id <> id").select(F.col("id").alias("a"), F.col("doc_id").alias("b"))
    several = member.groupBy("doc_id").agg(F.count_distinct("print").alias("k")).where("k > 1").select("doc_id")
    ties = ties.join(several, F.col("b") == F.col("doc_id"), "left_semi")
    label = connected(links.union(ties))
    by_print = classes.select("print", "id").join(label, "id", "left").select(
        "print", F.coalesce("label", "id").alias("component_id")
    )
    return feats.select("doc_id", "n", "print").join(
        by_print, "print", "left"
    ).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_first(docs: DataFrame, text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The documents without those whose component has a smaller id, all columns kept."""
    gone = materialize(
        components(docs, text_col, width, percent).where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    )
    return docs.join(gone, docs["doc_id"] == F.col("_gone"), "left_anti")
