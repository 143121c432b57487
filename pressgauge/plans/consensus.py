"""Many voices that say one thing: near-identical texts in a tight window, and near-identical embeddings.

Definitions and thresholds are this package's own. Candidates come from hashed
bands; every link is verified exactly. Members of a bucket are first compared with a
few hubs of it. Where that leaves a bucket in several parts, all pairs of members of
different parts are compared as well, so no pair of a bucket is left out; pairs that
links hold together already are spared, so a family of copies costs work a member.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressgauge.operators.dedup import top_k
from pressgauge.operators.graph import components, written

SHINGLE, SIMILAR = 5, 0.8
#: 64 bins of one permutation in 21 bands of 3: two texts of similarity 0.8 share no band once in a million times.
BINS, ROWS = 64, 3
#: Longs of a set's bitmap.
PARITY = 16
#: Partners a member names in the passes over its buckets; the last pass names all that are left.
PASSES = (4, 64, None)
#: Members of a block of a bucket's sets, or vectors; blocks meet in pairs.
SETS, VECTORS = 4096, 512


def shingle_set(text: Column, size: int = SHINGLE) -> Column:
    """Sorted distinct hashes of the word runs of a text; a text of fewer words is one run, one of none has no run."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), "")

    def runs(w: Column) -> Column:
        long = F.transform(F.slice(w, 1, F.greatest(F.size(w) - (size - 1), F.lit(0))), lambda _, i: F.xxhash64(*(F.get(w, i + k) for k in range(size))))
        return F.when(F.size(w).between(1, size - 1), F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(long)

    # a one-element array binds the words once instead of splitting the text for every position; no element is ever
    # null, so sort_array sorts plain longs, where array_sort asks a comparison function for every pair
    return F.sort_array(F.array_distinct(F.transform(F.array(words), runs)[0]))


def bands(grams: Column, bins: int = BINS, rows: int = ROWS) -> Column:
    """One-permutation MinHash, null for an empty set: each bin's least hash, an empty bin borrowing the next one's, hashed in bands."""
    shift = 64 - (bins.bit_length() - 1)
    bin_of = lambda x: F.shiftright(x, shift).cast("int")

    def signed(firsts: Column) -> Column:
        # a hash stands for its own bin and the empty ones before it, the first also for those after the last
        before = lambda i: F.when(i == 0, -bins // 2 - 1).otherwise(bin_of(F.get(firsts, i - 1)))
        own = F.flatten(F.transform(firsts, lambda f, i: F.array_repeat(f, bin_of(f) - before(i))))
        return F.concat(own, F.array_repeat(F.get(firsts, F.lit(0)), bins // 2 - 1 - bin_of(F.get(firsts, F.size(firsts) - 1))))

    def banded(signature: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(bins // rows - 1)), lambda j: F.xxhash64(j, *(F.get(signature, j * rows + k) for k in range(rows))))

    firsts = F.filter(grams, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(grams, i - 1))))
    return F.when(F.size(grams) > 0, F.transform(F.transform(F.array(firsts), signed), banded)[0])


def beside_hubs(rows: DataFrame, hubs: int) -> DataFrame:
    """The rows (bucket, id, n) of buckets of two or more, written with the bucket's first ``hubs`` members (id, n) in hash order.

    The rank limit is applied before the exchange, and the hub side has one row a
    bucket, so a hot bucket is a one-sided skew. The order is the same in every
    bucket, so a family of copies has the same hubs throughout.
    """
    rows = rows.where("id is not null")
    chosen = top_k(rows, ["bucket"], [F.xxhash64("id"), F.col("id")], hubs)
    hub = chosen.groupBy("bucket").agg(F.collect_list(F.struct("id", "n")).alias("hubs")).where("size(hubs) > 1")
    return written(rows.join(hub, "bucket"), "met")


def hub_pairs(met: DataFrame) -> DataFrame:
    """Distinct (a, b, na, nb), a < b: members of a ``bucket`` beside its hubs. The pairs without a hub are for ``beyond_hubs``."""
    each = met.select("id", "n", F.explode("hubs").alias("hub")).where("id <> hub.id")
    low = F.struct(F.col("id"), F.col("n"))
    both = each.select(F.least(low, F.col("hub")).alias("x"), F.greatest(low, F.col("hub")).alias("y"))
    return both.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), F.col("x.n").alias("na"), F.col("y.n").alias("nb")).distinct()


def beyond_hubs(met: DataFrame, parts: DataFrame, block: int) -> DataFrame:
    """cell, side, id, n, part: the members that are no hubs, of buckets whose links (id, part) leave them in several parts.

    A bucket is dealt into blocks of about ``block`` members, and a cell is where two
    blocks (sides 0 and 1) or a block and itself (side 2) meet, so every two members
    of a bucket are together in a cell, and a hot bucket goes to many tasks.
    """
    rest = met.where(~F.array_contains("hubs.id", F.col("id"))).select("bucket", "id", "n")
    labelled = rest.join(parts, "id", "left").select("bucket", "id", "n", F.coalesce("part", "id").alias("part"))
    sizes = labelled.groupBy("bucket").agg(F.count("*").alias("size"), F.min("part").alias("one"), F.max("part").alias("other"))
    dealt = sizes.where("one <> other").select("bucket", F.ceil(F.col("size") / block).alias("blocks"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks"))
    placed = labelled.join(dealt, "bucket").select("*", own.alias("own")).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("with"))
    cell = F.xxhash64("bucket", F.least("own", "with"), F.greatest("own", "with"))
    side = F.when(F.col("own") == F.col("with"), 2).otherwise((F.col("own") > F.col("with")).cast("int"))
    return placed.select(cell.alias("cell"), side.alias("side"), "id", "n", "part")


def text_sets(texts: DataFrame) -> DataFrame:
    """A table with a text, written with the text's shingle set (grams, n of them) and the hashes of its bands (buckets) instead."""
    sets = texts.withColumn("grams", shingle_set(F.col("text"))).drop("text")
    return written(sets.select("*", F.size("grams").alias("n"), bands(F.col("grams")).alias("buckets")), "shingles")


def parities(sets: DataFrame, longs: int = PARITY) -> DataFrame:
    """id, n, marks: a bitmap of ``longs`` longs for each set (id, n, grams), whether the number of hashes that fall on a bit is odd.

    A hash that one of two sets has alone changes one bit between their bitmaps, so
    they differ in at least as many hashes as the bitmaps do in bits.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        bits = 64 * longs
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                grams = part.column(2)
                hashes = grams.flatten().to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(len(grams)), grams.value_lengths().to_numpy(zero_copy_only=False))
                odd = np.bincount(row * bits + (hashes & (bits - 1)), minlength=len(grams) * bits) & 1
                marks = np.packbits(odd.astype(np.uint8)).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(marks) + 1, longs, dtype=np.int32)), pa.array(marks))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), lists], names=["id", "n", "marks"])

    return sets.select("id", "n", "grams").mapInArrow(run, f"id {sets.schema['id'].dataType.simpleString()}, n int, marks array<long>")


def _alike(common: Column, both: Column, least: float) -> Column:
    """Whether sets with so many common hashes, and so many in both sizes, are similar."""
    return common >= (both - common) * F.lit(least)


def alike_sets(sets: DataFrame, pairs: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) of a written table whose sets are similar; only the sets that have a pair are fetched."""
    met = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    narrow = sets.join(met, "id", "left_semi")
    both = pairs.join(narrow.select(F.col("id").alias("b"), F.col("grams").alias("gb")), "b").join(
        narrow.select(F.col("id").alias("a"), F.col("grams").alias("ga")), "a"
    )
    common = F.size(F.array_intersect("ga", "gb"))
    counted = both.select("a", "b", common.alias("c"), (F.size("ga") + F.size("gb")).alias("n"))
    return counted.where(_alike(F.col("c"), F.col("n"), least)).select("a", "b")


def cell_pairs(placed: DataFrame, least: float, most: int | None) -> DataFrame:
    """a, b: the pairs of a ``cell`` in different parts that sizes and bitmaps do not rule out, repeated over cells.

    ``placed`` has cell, side, id, n, part and marks. With ``most`` only the first so many of a member, and of its
    partners, are named; a row of nulls then tells that there are more.
    """
    placed = placed.select("cell", "side", "id", "n", "part", "marks").repartition("cell").sortWithinPartitions("cell", "side", F.xxhash64("id"), "id")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def near(part, n, marks, ones, others, same):
            """Pairs of members that may be linked, as positions, and whether there are more."""
            found, more, named, width = [], False, np.zeros(len(others), int), max(1, (1 << 17) // len(others))
            for at in range(0, len(ones), width):
                some = ones[at : at + width]
                small, large = np.minimum(n[some][:, None], n[others]), np.maximum(n[some][:, None], n[others])
                ok = (part[some][:, None] != part[others]) & (small >= large * least)
                if same:
                    ok &= some[:, None] < others
                i, j = np.nonzero(ok)
                x, y = some[i], others[j]
                both = n[x] + n[y]
                # the limit is that of _alike
                common = (both - np.bitwise_count(marks[x] ^ marks[y]).sum(axis=1, dtype=np.int64)) / 2
                ok[i, j] = common >= (both - common) * least
                if most is not None:
                    first = (np.cumsum(ok, axis=1) <= most) | (named + np.cumsum(ok, axis=0) <= most)
                    named += ok.sum(axis=0)
                    more |= bool((ok & ~first).any())
                    ok &= first
                i, j = np.nonzero(ok)
                found.append((some[i], others[j]))
            return found, more

        def met(table):
            cell, side, n = (table.column(k).to_numpy() for k in (0, 1, 3))
            ids, part = table.column(2).combine_chunks(), table.column(4).combine_chunks().dictionary_encode().indices.to_numpy()
            # of a signed number bitwise_count would take the absolute value
            marks = table.column(5).combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(cell), -1)
            n, found, more = n.astype(np.int64), [], False
            edges = [0, *(np.flatnonzero((np.diff(cell) != 0) | (np.diff(side) != 0)) + 1).tolist(), len(cell)]
            for k, (x, y) in enumerate(zip(edges, edges[1:])):
                ones = others = np.arange(x, y)
                if side[x] == 0:  # the other block comes next, if it has members
                    others = np.arange(y, edges[k + 2]) if y < len(cell) and cell[y] == cell[x] and side[y] == 1 else ones[:0]
                if side[x] != 1 and len(others):
                    pairs, cut = near(part, n, marks, ones, others, side[x] == 2)
                    found, more = found + pairs, more or cut
            a, b = (np.concatenate([f[k] for f in found] or [np.zeros(0, int)]) for k in (0, 1))
            gap = pa.nulls(int(more), ids.type)
            return pa.RecordBatch.from_arrays([pa.concat_arrays([ids.take(pa.array(x)), gap]) for x in (a, b)], names=["a", "b"])

        held = None  # the last cell of a batch may go on in the next
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            if table.num_rows:
                cell = table.column(0).to_numpy()
                whole = int(np.searchsorted(cell, cell[-1]))
                held = table.slice(whole)
                if whole:
                    yield met(table.slice(0, whole))
        if held is not None and held.num_rows:
            yield met(held)

    kind = placed.schema["id"].dataType.simpleString()
    return placed.mapInArrow(run, f"a {kind}, b {kind}").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def linked_sets(sets: DataFrame, least: float = SIMILAR, hubs: int = 3) -> tuple[DataFrame, DataFrame]:
    """(a, b: verified links between the sets of a table from ``text_sets``; id, part: what they hold together).

    Of two sets that share a bucket and are similar by ``least`` or more, the link is
    listed or both are in one part already. Bitmaps rule out most pairs that only
    share a band, so few sets are fetched.
    """
    met = beside_hubs(sets.select("id", "n", F.explode("buckets").alias("bucket")), hubs)
    pairs = written(hub_pairs(met).where(F.least("na", "nb") >= F.greatest("na", "nb") * least).select("a", "b"), "pairs")
    marks = written(parities(sets), "marks")
    marked = pairs.join(marks.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("marks").alias("mb")), "b").join(
        marks.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("marks").alias("ma")), "a"
    )
    apart = F.aggregate(F.zip_with("ma", "mb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, v: s + v)
    n = F.col("na") + F.col("nb")
    tried = written(marked.where(_alike((n - apart) / 2, n, least)).select("a", "b").distinct(), "candidates")
    links = written(alike_sets(sets, tried, least), "alike")
    parts = components(links)
    for k, most in enumerate(PASSES):
        cells = beyond_hubs(met, parts, SETS).join(marks.select("id", "marks"), "id")
        named = written(cell_pairs(cells, least, most).distinct(), f"named{k}")
        fresh = written(named.where("a is not null").join(tried, ["a", "b"], "left_anti"), f"fresh{k}")
        more = written(alike_sets(sets, fresh, least), f"alike{k}")
        if not more.isEmpty():
            links = links.unionByName(more)
            parts = components(links)
        if named.where("a is null").isEmpty():
            break
        tried = tried.unionByName(fresh)
    return links, parts


def similar_sets(sets: DataFrame, least: float = SIMILAR, hubs: int = 3) -> DataFrame:
    """a, b: verified links of similarity ``least`` or more, which hold together what all links of the buckets do."""
    return linked_sets(sets, least, hubs)[0]


def similar_texts(texts: DataFrame, least: float = SIMILAR, hubs: int = 3) -> DataFrame:
    """a, b: verified links of similarity ``least`` or more between the texts of a table of id and text."""
    return similar_sets(text_sets(texts.select("id", "text")), least, hubs)


def text_clusters(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = SIMILAR, hubs: int = 3) -> DataFrame:
    """text_hash, cluster_id for every distinct text: the least key among the texts that verified links hold together."""
    hashed = docs.select(F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("text_hash"), F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sets = text_sets(hashed.groupBy("text_hash").agg(F.min_by("text", "id").alias("text"), F.min("id").alias("id")))
    parts = linked_sets(sets, least, hubs)[1]
    return sets.select("text_hash", "id").join(parts, "id", "left").select("text_hash", F.coalesce("part", "id").alias("cluster_id"))


def sessions(sightings: DataFrame, group: str, source: str, ts: str, gap_seconds: int) -> DataFrame:
    """Per ``group``, runs of sightings in which none follows the one before by more than the gap.

    Sightings are first summed up per cell of the gap's width: all of one cell are
    in one run, and only neighbouring cells can be, so the window sees a row a cell,
    however many sightings a group has.
    """
    micros = F.unix_micros(F.col(ts))
    cells = sightings.groupBy(F.col(group).alias("grp"), F.floor(micros / F.lit(gap_seconds * 1_000_000)).alias("cell"), F.col(source).alias("source")).agg(
        F.min(micros).alias("first"), F.max(micros).alias("last"), F.count("*").alias("items")
    )
    cells = written(cells, "cells")
    in_order = Window.partitionBy("grp").orderBy("cell")
    spans = cells.groupBy("grp", "cell").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    opens = F.coalesce((F.col("first") - F.lag("last").over(in_order)) > gap_seconds * 1_000_000, F.lit(True))
    runs = spans.withColumn("opens", opens).select("grp", "cell", F.sum(F.col("opens").cast("int")).over(in_order).alias("session"))
    of = F.timestamp_micros
    return (
        cells.join(runs, ["grp", "cell"])
        .groupBy("grp", "session", "source").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("items").alias("items"))
        .groupBy("grp", "session")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("items").alias("items"), F.count("source").alias("sources"))
        .select(
            F.col("grp").alias(group), of("first").alias("first_seen"), of("last").alias("last_seen"),
            F.floor((F.col("last") - F.col("first")) / 1_000_000).alias("span_seconds"), "items", "sources",
        )
    )


def coordinated_text(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", ts: str = "seen_at",
    gap_seconds: int = 6 * 3600, least_sources: int = 2, least: float = SIMILAR, hubs: int = 3,
) -> DataFrame:
    """Runs of near-identical texts from several sources, none of which comes more than the gap after the one before.

    Returns cluster_id, first_seen, last_seen, span_seconds, items and sources.
    Equal texts are one node; a null text counts as empty; a null source counts for
    no source; items without a time are left out.
    """
    clusters = written(text_clusters(docs, key, text, least, hubs), "clusters")
    seen = docs.where(F.col(ts).isNotNull()).select(F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("text_hash"), F.col(source).alias("source"), F.col(ts).alias("ts"))
    placed = seen.join(clusters, "text_hash")
    return sessions(placed, "cluster_id", "source", "ts", gap_seconds).where(F.col("sources") >= least_sources)


# --- embeddings -------------------------------------------------------------------


def sketch_vectors(vectors: DataFrame, dims: int, tables: int, seed: int) -> DataFrame:
    """id, table, sig: 64 signs per table of a vector's products with random hyperplanes, the first sign highest.

    One matrix product per Arrow batch; the planes follow from the seed.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        planes = np.random.default_rng(seed).standard_normal((dims, tables * 64))
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                values = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dims)
                bits = (values @ planes > 0).reshape(len(values), tables, 64)
                sig = np.packbits(bits, axis=2).view(">u8")[:, :, 0].astype("<u8").view(np.int64)
                ids = np.repeat(part.column(0).to_numpy(zero_copy_only=False), tables)
                table = np.tile(np.arange(tables, dtype=np.int32), len(values))
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(table), pa.array(sig.ravel())], names=["id", "table", "sig"])

    return vectors.select("id", "vector").mapInArrow(run, "id long, table int, sig long")


def split_buckets(sketches: DataFrame, bits: int, most: int, step: int = 6) -> tuple[DataFrame, DataFrame]:
    """(rows of buckets of 2 to ``most`` members, rows of buckets that all 64 signs leave larger), as bucket and id.

    Buckets that are too large are split by ``step`` further hyperplanes, and again,
    until they are small; each round only handles what is still too large.
    """
    small, active, length = None, sketches, bits
    while True:
        keyed = active.withColumn("bucket", F.xxhash64(F.lit(length), "table", F.shiftrightunsigned("sig", 64 - length)))
        sizes = keyed.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
        sized = written(keyed.join(sizes, "bucket"), "buckets")
        fits = sized.where(F.col("size") <= most).select("bucket", "id")
        small = fits if small is None else small.unionByName(fits)
        active = sized.where(F.col("size") > most)
        if length == 64 or active.isEmpty():
            return small, active.select("bucket", "id")
        active, length = active.select(*sketches.columns), min(64, length + step)


def _dot(x: str, y: str) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def _normed(vectors: DataFrame) -> DataFrame:
    """The vectors that have a direction, with their norm."""
    return vectors.select("id", "vector", F.sqrt(_dot("vector", "vector")).alias("norm")).where("norm > 0")


def bucket_links(rows: DataFrame, vectors: DataFrame, least: float, forest: bool = False) -> DataFrame:
    """a, b: verified links between the members of each small ``bucket`` (bucket, id); a < b, repeated over buckets.

    A vector goes once to each of its buckets and meets the others there, so what is
    shuffled grows with the members and not with their pairs. ``forest`` gives only so
    many of the links as hold together what all of them do, at most one a member.
    Matrix products decide what is not within rounding of the limit, sums in the
    order of the dimensions decide the rest.
    """
    placed = rows.join(_normed(vectors), "id").select("bucket", "id", "norm", "vector").repartition("bucket").sortWithinPartitions("bucket")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def links(v, norm):
            """Which members are linked, as a matrix."""
            product, scale = v @ v.T, np.outer(norm, norm)
            sure = product >= scale * (least + 1e-9)
            i, j = np.nonzero(np.triu(~sure & ~(product < scale * (least - 1e-9)), 1))
            if len(i):
                # as in Spark, a sum that is no number is above every limit
                sure[i, j] = sure[j, i] = ~(np.cumsum(v[i] * v[j], axis=1)[:, -1] < scale[i, j] * least)
            np.fill_diagonal(sure, False)
            return sure

        def tree(linked):
            """Pairs of a spanning forest."""
            left, parent, child = linked.any(axis=0), [], []
            while left.any():
                front = np.array([left.argmax()])
                left[front] = False
                while len(front):
                    seen = linked[front] & left
                    new = np.flatnonzero(seen.any(axis=0))
                    parent.append(front[seen[:, new].argmax(axis=0)])
                    child.append(new)
                    left[new] = False
                    front = new
            return (np.concatenate(parent), np.concatenate(child)) if parent else (np.zeros(0, int),) * 2

        def met(table):
            ids, norm = table.column(1).to_numpy(), table.column(2).to_numpy()
            bucket = table.column(0).to_numpy()
            values = table.column(3).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
            edges = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(ids)]
            found = []
            with np.errstate(all="ignore"):
                for x, y in zip(edges, edges[1:]):
                    linked = links(values[x:y], norm[x:y])
                    i, j = tree(linked) if forest else np.nonzero(np.triu(linked, 1))
                    found.append((ids[i + x], ids[j + x]))
            one, two = (np.concatenate(side) for side in zip(*found))
            apart = one != two
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(one, two)[apart]), pa.array(np.maximum(one, two)[apart])], names=["a", "b"])

        held = None  # the last bucket of a batch may go on in the next
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            if table.num_rows:
                bucket = table.column(0).to_numpy()
                whole = int(np.searchsorted(bucket, bucket[-1]))
                held = table.slice(whole)
                if whole:
                    yield met(table.slice(0, whole))
        if held is not None and held.num_rows:
            yield met(held)

    return placed.mapInArrow(run, "a long, b long")


def similar_vectors(
    vectors: DataFrame, least: float, tables: int = 20, bits: int = 10, most: int = 64, hubs: int = 3, seed: int = 7, forest: bool = False
) -> DataFrame:
    """a, b: verified links of cosine ``least`` or more between the vectors of a written table of id and vector.

    With ``forest`` a small bucket gives a spanning forest of its links, which holds the same vectors together. Of
    buckets that all 64 signs leave larger, members are linked to hubs, and where that leaves a bucket in several
    parts, its blocks give a spanning forest each.
    """
    first = vectors.select(F.size("vector").alias("n")).first()
    if first is None:
        return vectors.select(F.col("id").alias("a"), F.col("id").alias("b"))
    small, hot = split_buckets(written(sketch_vectors(vectors, first["n"], tables, seed), "sketches"), bits, most)
    listed = bucket_links(small, vectors, least, forest)
    if hot.isEmpty():
        return listed.distinct()
    met = beside_hubs(hot.withColumn("n", F.lit(1)), hubs)
    pairs = hub_pairs(met).select("a", "b")
    normed = _normed(vectors)
    both = pairs.join(normed.select(F.col("id").alias("b"), F.col("vector").alias("vb"), F.col("norm").alias("nb")), "b").join(
        normed.select(F.col("id").alias("a"), F.col("vector").alias("va"), F.col("norm").alias("na")), "a"
    )
    far = written(both.where(_dot("va", "vb") >= F.col("na") * F.col("nb") * F.lit(least)).select("a", "b"), "far")
    cells = beyond_hubs(met, components(far), VECTORS).select(F.col("cell").alias("bucket"), "id")
    return listed.unionByName(far).unionByName(bucket_links(cells, vectors, least, forest=True)).distinct()


def vector_clusters(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = 0.9, **how) -> DataFrame:
    """vector_hash, cluster_id for every distinct vector: the least key among the vectors that verified links hold together."""
    held = vectors.where(F.col(vector).isNotNull()).select(_vector_hash(vector).alias("vector_hash"), F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    nodes = written(held.groupBy("vector_hash").agg(F.min("id").alias("id"), F.min_by("vector", "id").alias("vector")), "vectors")
    parts = components(similar_vectors(nodes.select("id", "vector"), least, forest=True, **how))
    return nodes.select("vector_hash", "id").join(parts, "id", "left").select("vector_hash", F.coalesce("part", "id").alias("cluster_id"))


def _vector_hash(vector: str) -> Column:
    doubles = F.col(vector).cast("array<double>")
    return F.struct(F.xxhash64(doubles).alias("x"), F.xxhash64(F.lit(1), doubles).alias("y"))


def semantic_consensus(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", voice: str = "label", least: float = 0.9, least_voices: int = 2, **how
) -> DataFrame:
    """Clusters of near-identical vectors that several voices hold: cluster_id, items, voices.

    Equal vectors are one node, so copies cost nothing; null vectors are left out,
    zero vectors link to nothing, a null voice counts for no voice. All vectors are
    of one length.
    """
    clusters = vector_clusters(vectors, key, vector, least, **how)
    held = vectors.where(F.col(vector).isNotNull()).groupBy(_vector_hash(vector).alias("vector_hash"), F.col(voice).alias("voice")).agg(F.count("*").alias("n"))
    return (
        held.join(clusters, "vector_hash").groupBy("cluster_id", "voice").agg(F.sum("n").alias("n"))
        .groupBy("cluster_id").agg(F.sum("n").alias("items"), F.count("voice").alias("voices"))
        .where(F.col("voices") >= least_voices)
    )
