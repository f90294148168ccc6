"""Near duplicates: an n-gram Jaccard join on token-combination prefixes, and its components.

A document is the set of its five-word shingles. Equal sets are one node from the start. Tokens
(shingles) are ordered by document frequency, then hash. Two sets with Jaccard of 80% or more
overlap in at least 80% of the larger one, so if a set's prefix leaves no more than that overlap
outside, a partner must meet it inside. Tokens fall in classes: rare ones (at most ``RARE`` nodes)
are indexed alone; frequent ones are divided by hash into sub-classes and indexed as pairs within a
sub-class. A prefix is extended until the tokens beyond the first of each sub-class make up for it:
with fewer pairs shared than that, too much of the prefix would be missing in the partner.
Every candidate is verified on the whole sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandloom.llm import key_counts as kc
from demandloom.llm import tokens
from demandloom.llm.lm_score import word_keys
from demandloom.llm.store import split_lookup
from demandloom.llm.store import tidily_written as written

WORDS = 5
#: Linked if PERCENT_OF * intersection >= PERCENT * union.
PERCENT = 80
#: Tokens of at most so many nodes are indexed alone.
RARE = 32
#: Sets from these sizes on divide frequent tokens into so many sub-classes; smaller ones index
#: them alone. Sets within 1/0.8 above a border follow both sides, so any two linked sets share a way.
SCHEMES = ((0, 0), (16, 8), (128, 64), (1024, 512), (8192, 4096))

_U64 = np.uint64


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; with fewer than five words, all words as one."""
    codes, offsets, words = tokens.split_words(pc.ascii_lower(texts))
    keys = word_keys(words)[codes] if len(codes) else np.zeros(0, _U64)
    wide = np.concatenate([keys, np.zeros(WORDS, _U64)])
    rolled = wide[: len(keys)].copy()
    for step in range(1, WORDS):
        rolled = kc.mixed(rolled * _U64(0x9E3779B97F4A7C15) + wide[step : step + len(keys)])
    sets = []
    for a, b in zip(offsets[:-1], offsets[1:]):
        if b - a >= WORDS:
            sets.append(np.unique(rolled[a : b - WORDS + 1]))
        elif b > a:
            sets.append(np.array([xxhash.xxh3_64_intdigest(keys[a:b].tobytes(), seed=int(b - a))], _U64))
        else:
            sets.append(np.zeros(0, _U64))
    return sets


def digest(one: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(one.tobytes())


def described(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, digest`` for every row; the digest of an empty set is null."""

    def run(batches):
        for batch in batches:
            for first, texts in tokens.text_slices(batch.column(1)):
                sets = shingle_sets(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(sets)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([digest(s) if len(s) else None for s in sets], pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "digest"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, digest binary"
    )


def signatures(one: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Signatures of a set, given the document frequency of each of its tokens."""
    n = len(one)
    need = n - (PERCENT * n + 99) // 100 + 1
    order = np.lexsort((one, df))
    one, df = one[order], df[order]
    rare = int(np.searchsorted(df, RARE, side="right"))
    alone = one[: min(rare, need)]
    found = [alone[df[: len(alone)] > 1]]
    if rare < need:
        often = one[rare:]
        starts = [s for s, _ in SCHEMES]
        last = max(i for i, s in enumerate(starts) if n >= s)
        own = [last] if last == 0 or PERCENT * n >= 100 * starts[last] + 100 else [last - 1, last]
        for scheme in own:
            classes = SCHEMES[scheme][1]
            if not classes:
                found.append(often[: need - rare])
                continue
            group = (kc.mixed(often ^ _U64(0xA5A5A5A5)) % _U64(classes)).astype(np.int64)
            # Tokens beyond the first of their sub-class, counted along the order.
            first = np.zeros(len(often), bool)
            first[np.unique(group, return_index=True)[1]] = True
            length = int(np.searchsorted(np.cumsum(~first), need - rare)) + 1
            head, group = often[:length], group[:length]
            for g in np.unique(group):
                members = np.sort(head[group == g])
                i, j = np.triu_indices(len(members), 1)
                found.append(kc.mixed(members[i] * _U64(31) + kc.mixed(members[j]) + _U64(scheme + 1)))
    return np.unique(np.concatenate(found))


#: Words of the bitmap of a set's tokens, 64 bits each.
BITMAP = 16


def bitmap(one: np.ndarray) -> np.ndarray:
    """A bit for each token's place: tokens with a bit that another set lacks are not in it."""
    out = np.zeros(BITMAP, _U64)
    place = one >> _U64(54)
    np.bitwise_or.at(out, (place >> _U64(6)).astype(np.int64), _U64(1) << (place & _U64(63)))
    return out.view(np.int64)


def node_of(digest_: bytes) -> int:
    """The number of a node: the first 60 bits of its set's digest."""
    return int.from_bytes(digest_[:8], "big") >> 4


def node_number(digests: Column) -> Column:
    """``node_of`` as an expression: 60 bits are 15 hex digits."""
    return F.conv(F.substring(F.hex(digests), 1, 15), 16, 10).cast("long")


def short_keys(total_bytes: int) -> int:
    """Bits to drop from tokens when they are counted: some 2**13 keys are left for each byte of text.

    Tokens that fall together count as one, which makes them seem more frequent, never less. That
    keeps the order and the classes the same for all sets and the join exact.
    """
    return max(0, 64 - 13 - max(1, total_bytes).bit_length())


def signed(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, n, common, bits, sigs, tokens`` for each node that has a signature another might have.

    ``common`` counts the tokens that are in other nodes too. ``nodes`` are ``doc_id, digest`` of one
    document per distinct set. Frequencies are counted over the nodes' sets.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks, parts = kc.sizes(rows)
    drop = _U64(short_keys(blocks * kc.BLOCK_BYTES))
    dealt = rows.select(kc.block_of(blocks), "doc_id", "text")
    notes = nodes.select(
        kc.block_of(blocks), F.lit(-1).alias("part"), F.lit(None).cast("binary").alias("counts"), "doc_id", "digest"
    )

    def own_sets(table: pa.Table, notes: pa.Table) -> dict[int, np.ndarray]:
        chosen = notes.filter(pc.equal(notes.column("part"), -1))
        wanted = set(zip(chosen.column("doc_id").to_pylist(), chosen.column("digest").to_pylist()))
        table = table.filter(pc.is_in(table.column("doc_id"), chosen.column("doc_id").combine_chunks()))
        out: dict[int, np.ndarray] = {}
        if table.num_rows:
            names = iter(table.column("doc_id").to_pylist())
            for _, texts in tokens.text_slices(table.column("text")):
                for one, name in zip(shingle_sets(texts), names):
                    found = digest(one) if len(one) else None
                    if (name, found) in wanted:
                        out[node_of(found)] = one
        return dict(sorted(out.items()))

    def counted(sets: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(np.concatenate([np.unique(one >> drop) for one in sets.values()]) << drop, return_counts=True)

    def emit(table: pa.Table, notes: pa.Table) -> pa.Table:
        sets = own_sets(table, notes)
        if not sets:
            return kc.sent(0, np.zeros(0, _U64), np.zeros(0, np.int64), parts, drop)
        return kc.sent(table.column("block")[0].as_py(), *counted(sets), parts, drop)

    by_block = dealt.groupBy("block")
    emitted = by_block.cogroup(notes.groupBy("block")).applyInArrow(emit, kc.SENT)
    answers = written(kc.totals(emitted, drop=drop), "shingle-counts")

    def sign(table: pa.Table, notes: pa.Table) -> pa.Table:
        sets = own_sets(table, notes)
        names, sizes, common, bits, sigs, kept = [], [], [], [], [], []
        if sets:
            keys, _ = counted(sets)
            df = kc.answered(notes.filter(pc.greater_equal(notes.column("part"), 0)))
            for name, one in sets.items():
                times = df[np.searchsorted(keys, one >> drop << drop)].astype(np.int64)
                own = signatures(one, times)
                if len(own):
                    names.append(name)
                    sizes.append(len(one))
                    common.append(int((times > 1).sum()))
                    bits.append(bitmap(one))
                    sigs.append(own.view(np.int64))
                    kept.append(one.tobytes())
        return pa.table(
            {
                "node": pa.array(names, pa.int64()),
                "n": pa.array(sizes, pa.int64()),
                "common": pa.array(common, pa.int64()),
                "bits": pa.array(bits, pa.list_(pa.int64())),
                "sigs": pa.array(sigs, pa.list_(pa.int64())),
                "tokens": pa.array(kept, pa.binary()),
            }
        )

    found = answers.select(
        "block", "part", "counts", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("digest")
    )
    told = notes.unionByName(found).groupBy("block")
    return written(
        dealt.groupBy("block").cogroup(told).applyInArrow(
            sign, "node long, n long, common long, bits array<long>, sigs array<long>, tokens binary"
        ),
        "signed-sets",
    )


def may_link(n: Column, common: Column, other_n: Column, other_common: Column) -> Column:
    """True if an overlap of all tokens that others have would be enough; sizes are bounded by it."""
    return (100 + PERCENT) * F.least(common, other_common) >= PERCENT * (n + other_n)


def bits_allow(n: Column, bits: Column, other_n: Column, other_bits: Column) -> Column:
    """True unless the bits that differ leave too small an overlap: each stands for a token not shared."""
    apart = sum((F.bit_count(bits[i].bitwiseXOR(other_bits[i])) for i in range(BITMAP)), F.lit(0))
    return (100 + PERCENT) * (n + other_n - apart) >= 2 * PERCENT * (n + other_n)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that link, from their whole sets ``node, tokens``."""

    def run(batches):
        for batch in batches:
            left, right = batch.column("ta").to_pylist(), batch.column("tb").to_pylist()
            keep = []
            for x, y in zip(left, right):
                u, v = np.frombuffer(x, _U64), np.frombuffer(y, _U64)
                both = len(np.intersect1d(u, v, assume_unique=True))
                keep.append(100 * both >= PERCENT * (len(u) + len(v) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(mask), batch.column("b").filter(mask)], names=["a", "b"]
            )

    first = sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta"))
    second = sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb"))
    return pairs.join(second, "b").join(first, "a").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for the nodes of ``links`` ``a, b``.

    Labels start at the node and take the smallest label around, then the label of that label,
    which doubles the reach of a step. Each step is a written table; nothing is gathered.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(both.distinct(), "links")
    labels = written(
        edges.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("node"), F.least("a", "m").alias("component")
        ),
        "labels",
    )
    while True:
        near = (
            edges.join(labels, edges["b"] == labels["node"])
            .groupBy("a")
            .agg(F.min("component").alias("m"))
        )
        better = labels.join(near, F.col("node") == F.col("a"), "left").select(
            "node", F.col("component").alias("old"), F.least("component", "m").alias("component")
        )
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        step = written(
            better.join(jump, "component", "left").select(
                "node", "old", F.least("component", "further").alias("component")
            ),
            "labels",
        )
        changed = step.where(F.col("old") != F.col("component")).limit(1).count()
        labels = step.select("node", "component")
        if not changed:
            return labels


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` of all nodes, after more ``links``: only the components that these join are walked."""
    side = {n: labels.select(F.col("node").alias(n), F.col("component").alias(f"c{n}")) for n in ("a", "b")}
    between = links.join(side["a"], "a").join(side["b"], "b").where("ca <> cb")
    joined = components(between.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    further = joined.select(F.col("node").alias("component"), F.col("component").alias("further"))
    return written(
        labels.join(further, "component", "left").select(
            "node", F.coalesce("further", "component").alias("component")
        ),
        "components",
    )


#: Signatures of at most so many nodes compare all their pairs; larger ones go through bundles.
FEW = 32
#: Tokens of a block of a bundle's nodes.
BLOCK_TOKENS = 1_000_000


def linked(sets: DataFrame) -> DataFrame:
    """``node, component`` of all nodes of ``sets``: ``node, n, common, bits, sigs, tokens``.

    First the node with most common tokens of each signature is compared with all others, which
    unites groups of near copies at the cost of their size. Nodes of small signatures that are still
    apart are then compared in pairs, those of large ones in bundles. A signature whose nodes are in
    one component needs nothing more, so no pair that could join two components is left out.
    """
    posts = sets.select("node", "n", "common", F.explode("sigs").alias("sig"))
    shared = posts.groupBy("sig").agg(
        F.count(F.lit(1)).alias("members"), F.min(F.struct(-F.col("common"), "node"))["node"].alias("lead")
    )
    shared = written(shared.where("members > 1"), "shared-signatures")
    posts = written(split_lookup(posts, shared, "sig", "members", "inner"), "postings")
    leads = sets.select(F.col("node").alias("lead"), F.col("n").alias("an"), F.col("common").alias("as"))
    pairs = (
        posts.where("node <> lead")
        .select("lead", F.col("node").alias("b"), "n", "common")
        .distinct()
        .join(leads, "lead")
        .where(may_link(F.col("n"), F.col("common"), F.col("an"), F.col("as")))
        .select(F.col("lead").alias("a"), "b")
    )
    alone = sets.select("node", F.col("node").alias("component"))
    labels = merged(alone, written(verified(pairs, sets), "verified"))
    labels = merged(labels, written(verified(few_pairs(posts, sets, labels), sets), "verified"))
    return merged(labels, written(bundle_links(posts, sets, labels), "bundle-links"))


def still_apart(posts: DataFrame, labels: DataFrame) -> DataFrame:
    """The postings, with ``component``, of signatures whose nodes are in several components."""
    known = posts.join(labels, "node")
    mixed = known.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return known.join(mixed.where("low <> high").select("sig"), "sig", "left_semi")


def few_pairs(posts: DataFrame, sets: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of different components that share a signature of at most ``FEW`` nodes."""
    left = still_apart(posts.where(F.col("members") <= FEW), labels)
    left = written(left.select("sig", "node", "n", "common", "component").join(sets.select("node", "bits"), "node"), "open-postings")
    names = {"node": "a", "n": "an", "common": "as", "bits": "ab", "component": "ac"}
    first = left.withColumnsRenamed(names)
    return (
        left.join(first, "sig")
        .where((F.col("node") > F.col("a")) & (F.col("component") != F.col("ac")))
        .where(may_link(F.col("n"), F.col("common"), F.col("an"), F.col("as")))
        .where(bits_allow(F.col("n"), F.col("bits"), F.col("an"), F.col("ab")))
        .select("a", F.col("node").alias("b"))
        .distinct()
    )


def bundle_links(posts: DataFrame, sets: DataFrame, labels: DataFrame) -> DataFrame:
    """Links ``a, b`` between components that share a signature of more than ``FEW`` nodes.

    Near copies share most of their signatures, so the signatures that are still apart are joined to
    bundles, and two nodes meet once in a bundle instead of once for each signature. All nodes of a
    bundle's largest component are one already: only the others are compared with the rest, in
    blocks of bounded tokens, by counting common tokens over an index of the block. Links alone come out.
    """
    apart = still_apart(posts.where(F.col("members") > FEW), labels)
    apart = written(apart.select("sig", "lead", "node", "component").distinct(), "open-large")
    edges = apart.where("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
    bundles = components(edges).withColumnRenamed("component", "bundle")
    nodes = bundles.join(labels, "node").join(sets.select("node", "n"), "node")
    nodes = written(nodes, "bundled")
    sizes = nodes.groupBy("bundle", "component").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("t"))
    totals = sizes.groupBy("bundle").agg(
        F.max(F.struct("m", "component"))["component"].alias("home"), F.sum("t").alias("all_tokens"), F.max_by("t", F.struct("m", "component")).alias("home_tokens")
    )
    blocks = lambda t: 1 + F.floor(t / BLOCK_TOKENS).cast("int")
    totals = totals.select(
        "bundle", "home", blocks(F.col("all_tokens")).alias("nb"), blocks(F.col("all_tokens") - F.col("home_tokens")).alias("ob")
    )
    placed = nodes.join(totals, "bundle").join(sets.select("node", "tokens"), "node")
    up_to = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    deal = lambda c, seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(c)).cast("int")
    rest = placed.where(F.col("component") != F.col("home"))
    keys, names = ["bundle", "o", "e"], ["bundle", "o", "e", "node", "component", "tokens"]
    # Both sides come from one table, so one of them gets columns of its own.
    rest = rest.withColumns({"o": deal("ob", 1), "e": up_to("nb")}).select(*[F.col(c).alias(c) for c in names])
    every = placed.withColumns({"e": deal("nb", 2), "o": up_to("ob")}).select(*names)
    return rest.groupBy(*keys).cogroup(every.groupBy(*keys)).applyInArrow(_block_links, "a long, b long")


def _block_links(rest: pa.Table, every: pa.Table) -> pa.Table:
    """Links of two blocks of nodes, between different components."""
    found: list[tuple[int, int]] = []
    if rest.num_rows and every.num_rows:
        own = [np.frombuffer(t, _U64) for t in rest.column("tokens").to_pylist()]
        node, component = (np.asarray(rest.column(c)) for c in ("node", "component"))
        size = np.array([len(t) for t in own])
        flat = np.concatenate(own)
        order = np.argsort(flat, kind="stable")
        holder = np.repeat(np.arange(len(own)), size)[order]
        words, starts = np.unique(flat[order], return_index=True)
        ends = np.append(starts[1:], len(flat))
        for b, c, t in zip(*(every.column(x).to_pylist() for x in ("node", "component", "tokens"))):
            one = np.frombuffer(t, _U64)
            at = np.minimum(np.searchsorted(words, one), len(words) - 1)
            at = at[words[at] == one]
            both = np.bincount(holder[tokens.ragged(starts[at], ends[at] - starts[at])], minlength=len(own))
            near = (100 + PERCENT) * both >= PERCENT * (size + len(one))
            found += [(int(a), b) for a in node[near & (component != c)]]
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs`` (``doc_id, text``).

    Null and blank texts have the empty set and link with nothing: their component is themselves.
    Rows of one doc_id with different texts link each by its own text. A null doc_id has a null
    component unless its component has a doc_id. An empty table gives no rows.
    """
    rows = written(described(docs), "shingle-sets")
    groups = written(
        rows.where(F.col("digest").isNotNull())
        .groupBy("digest")
        .agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies")),
        "set-groups",
    )
    nodes = groups.where(F.col("first_id").isNotNull()).select(F.col("first_id").alias("doc_id"), "digest")
    labels = linked(signed(docs, nodes))
    named = written(groups.withColumn("node", node_number(F.col("digest"))).join(labels, "node", "left"), "named-sets")
    least = named.where(F.col("component").isNotNull()).groupBy("component").agg(
        F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("members")
    )
    classes = written(
        split_lookup(named, written(least, "least-ids"), "component", "members", "left").select(
            "digest", "copies", F.coalesce("component_id", "first_id").alias("component_id")
        ),
        "set-components",
    )
    met = split_lookup(rows.where(F.col("digest").isNotNull()), classes, "digest", "copies", "inner")
    empty = rows.where(F.col("digest").isNull()).withColumn("component_id", F.col("doc_id"))
    names = ["doc_id", "n_shingles", "component_id"]
    return met.select(*names).unionByName(empty.select(*names))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: its smallest doc_id, once; columns unchanged.

    Rows with a null doc_id cannot be told apart and all stay.
    """
    keep = near_duplicates(docs).where(F.col("doc_id") == F.col("component_id"))
    ids = keep.select(F.col("doc_id").alias("__id")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("__id"))
    once = Window.partitionBy("__id").orderBy(F.col("row.text"))
    first = rows.join(ids, "__id", "left_semi").withColumn("__nth", F.row_number().over(once))
    unnamed = rows.where(F.col("__id").isNull())
    return first.where("__nth = 1").select("row.*").unionByName(unnamed.select("row.*"))


def query(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{folder}/documents.parquet"))
