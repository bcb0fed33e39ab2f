"""Near-duplicate groups by SuperMinHash, banding, exact verification and union-find."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import WordHashes, durable, forget, mix, shingle_set
from barloom.llm.graph import components

#: Shingle hashes that are signed together; bounds a task's memory.
CHUNK = 150_000


def superminhash(sets: list[np.ndarray], perms: int) -> np.ndarray:
    """A signature of `perms` values for each set of distinct 64-bit hashes (empty: all ones).

    Each element walks a random permutation of the positions, its own; at step j it offers j plus
    a fraction to one of them, and a position keeps the least offer. So no position below j can
    change once all hold less than j + 1: a set stops there, a long one after its first step.
    Sets are walked together, a step at a time; values are j * 2**32 plus 32 bits of fraction.
    """
    out = np.full((len(sets), perms), np.iinfo(np.uint64).max, np.uint64)
    if not sets:
        return out
    flat = out.reshape(-1)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    element = np.concatenate(sets)
    places = None
    for j in range(perms):
        if not len(element):
            break
        draw = mix(element + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        pick = j + (((draw & np.uint64(0xFFFFFFFF)) * np.uint64(perms - j)) >> np.uint64(32)).astype(np.int64)
        if places is None:
            at = pick
        else:
            rows = np.arange(len(element))
            at = places[rows, pick].astype(np.int64)
            places[rows, pick] = places[:, j]
            places[:, j] = at
        np.minimum.at(flat, owner * perms + at, (draw >> np.uint64(32)) + np.uint64(j << 32))
        going = out.max(axis=1) >= np.uint64((j + 1) << 32)
        stay = going[owner]
        if places is None:
            element, owner, pick = element[stay], owner[stay], pick[stay]
            places = np.tile(np.arange(perms, dtype=np.uint16), (len(element), 1))
            rows = np.arange(len(element))
            places[rows, pick], places[:, 0] = places[:, 0].copy(), pick
        elif not stay.all():
            element, owner, places = element[stay], owner[stay], places[stay]
    return out


def _sketcher(shingle: int, perms: int, rows: int):
    def sketch(batches):
        import pyarrow as pa
        import xxhash

        hashes = WordHashes()
        band = np.arange(perms // rows, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)

        def emit(ids, sets):
            signs = superminhash(sets, perms)
            keys = np.zeros((len(sets), perms // rows), np.uint64) + band
            for i in range(rows):
                keys = mix(keys + signs[:, i::rows][:, : perms // rows])
            low = mix(signs).astype(np.uint8)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(sets) + 1) * (perms // rows), pa.int32()), pa.array(keys.reshape(-1).view(np.int64))
                    ),
                    pa.array([x.tobytes() for x in low], pa.binary()),
                ],
                ["id", "n_shingles", "digest", "bands", "sign"],
            )

        for batch in batches:
            ids, sets, held = [], [], 0
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(i)
                sets.append(shingle_set(text, shingle, hashes))
                held += len(sets[-1])
                if held >= CHUNK:
                    yield emit(ids, sets)
                    ids, sets, held = [], [], 0
            if ids:
                yield emit(ids, sets)

    return sketch


def _setter(shingle: int):
    def sets(batches):
        import pyarrow as pa

        hashes = WordHashes()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for at in range(0, len(texts), 500):
                part = [shingle_set(t, shingle, hashes).tobytes() for t in texts[at : at + 500]]
                yield pa.RecordBatch.from_arrays([ids.slice(at, 500), pa.array(part, pa.binary())], ["id", "hashes"])

    return sets


def _agreeing(least: float):
    """Pairs whose signatures agree in at least that share of positions."""

    def keep(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for k in (2, 3))
            yield batch.filter(_mask((x == y).mean(axis=1) >= least)).select([0, 1])

    return keep


def _mask(x):
    import pyarrow as pa

    return pa.array(np.asarray(x, bool))


def _confirmer(percent: int):
    """Pairs with 100 * |A & B| >= percent * |A | B| over whole sets."""

    def keep(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.filter(_mask(ok)).select([0, 1])

    return keep


def _grouped(batches, process):
    """Whole runs of equal first columns, which arrive sorted, whatever batches they arrive in."""
    import pyarrow as pa

    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        keys = table.column(0).to_numpy()
        if not len(keys):
            continue
        last = int(np.searchsorted(keys, keys[-1]))
        held = table.slice(last)
        if last:
            yield from process(table.slice(0, last), keys[:last])
    if held is not None:
        yield from process(held, held.column(0).to_numpy())


def _edges(pairs):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])


def _plausible_forest(percent: int, least: float):
    """For each bucket of (key, id, root, n, sign): links that join what sizes and signatures leave in question.

    Only members of different components are held against each other. Not each pair comes out, but
    enough of them to connect all that are in question: fewer than the bucket has members.
    """

    def forest(ids, roots, n, sign):
        label = np.arange(len(ids))
        for at in range(0, len(ids), 64):
            part = slice(at, at + 64)
            ok = (sign[part, None, :] == sign[None, :, :]).mean(axis=2) >= least
            ok &= roots[part, None] != roots[None, :]
            ok &= 100 * np.minimum(n[part, None], n[None, :]) >= percent * np.maximum(n[part, None], n[None, :])
            for i in np.flatnonzero(ok.any(axis=1)):
                met = np.unique(np.append(label[ok[i]], label[at + i]))
                if len(met) > 1:
                    label[np.isin(label, met)] = met[0]
        return [(int(ids[x]), int(ids[i])) for i, x in enumerate(label) if x != i]

    def process(table, keys):
        ids, roots, n = (table.column(k).to_numpy() for k in (1, 2, 3))
        sign = np.frombuffer(b"".join(table.column(4).to_pylist()), np.uint8).reshape(len(ids), -1)
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        sizes = np.diff(np.append(starts, len(keys)))
        two = starts[sizes == 2]
        ok = (sign[two] == sign[two + 1]).mean(axis=1) >= least if len(two) else np.zeros(0, bool)
        ok &= (roots[two] != roots[two + 1]) & (100 * np.minimum(n[two], n[two + 1]) >= percent * np.maximum(n[two], n[two + 1]))
        out = list(zip(ids[two[ok]].tolist(), ids[two[ok] + 1].tolist(), strict=True))
        for start, size in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
            part = slice(start, start + size)
            out += forest(ids[part], roots[part], n[part], sign[part])
        yield _edges(sorted(set(out)))

    return lambda batches: _grouped(batches, process)


def _cell_bounds(keys) -> list[tuple[int, int]]:
    starts = [*np.flatnonzero(np.append(True, keys[1:] != keys[:-1])).tolist(), len(keys)]
    return list(zip(starts, starts[1:], strict=False))


def _sieved(percent: int, least: float):
    """Of each cell of (cell, member, id, root, n, sign) the rows (cell, member, id, root) that have a plausible partner on the other side."""

    def process(table, keys):
        import pyarrow as pa

        member, roots, n = (np.asarray(table.column(k).to_numpy()) for k in (1, 3, 4))
        member = member.astype(bool)
        sign = np.frombuffer(b"".join(table.column(5).to_pylist()), np.uint8).reshape(len(keys), -1)
        keep = np.zeros(len(keys), bool)
        for a, b in _cell_bounds(keys):
            asking, asked = a + np.flatnonzero(~member[a:b]), a + np.flatnonzero(member[a:b])
            for at in range(0, len(asking), 64):
                part = asking[at : at + 64]
                ok = 100 * np.minimum(n[part, None], n[None, asked]) >= percent * np.maximum(n[part, None], n[None, asked])
                ok &= roots[part, None] != roots[None, asked]
                x, y = np.nonzero(ok)
                near = (sign[part[x]] == sign[asked[y]]).mean(axis=1) >= least if len(x) else np.zeros(0, bool)
                keep[part[x[near]]] = keep[asked[y[near]]] = True
        yield pa.RecordBatch.from_arrays([c.combine_chunks() for c in table.filter(_mask(keep)).select([0, 1, 2, 3]).columns], ["cell", "member", "id", "root"])

    return lambda batches: _grouped(batches, process)


def _block_links(percent: int, compared: list | None = None):
    """For each cell of (cell, member, id, root, hashes): links of its askers, which come first, to its members.

    Shingles that over half of the askers hold are counted, not compared: with what else two sets share, the lesser
    count bounds what they have in common. Only pairs that can reach the threshold by that, and that links of this cell haven't
    joined yet, are compared as whole sets; so documents that share a common frame and nothing else cost no comparison. `compared` gets
    the number of such comparisons, for tests.
    """

    def process(table, keys):
        member, ids, roots = (table.column(k).to_pylist() for k in (1, 2, 3))
        sets = [np.frombuffer(x, np.uint64) for x in table.column(4).to_pylist()]
        out = []
        for a, b in _cell_bounds(keys):
            asking = [i for i in range(a, b) if not member[i]]
            if not asking:
                continue
            owner = np.repeat(np.arange(len(asking)), [len(sets[i]) for i in asking])
            held = np.concatenate([sets[i] for i in asking])
            order = np.argsort(held, kind="stable")
            held, owner = held[order], owner[order]
            first = np.flatnonzero(np.append(True, held[1:] != held[:-1]))
            values, times = held[first], np.diff(np.append(first, len(held)))
            common = times * 2 > max(len(asking), 7)
            n = np.array([len(sets[i]) for i in asking])
            often = np.bincount(owner[np.repeat(common, times)], minlength=len(asking))
            parent: dict[int, int] = {}

            def root(x, parent=parent):
                while parent.setdefault(x, x) != x:
                    parent[x] = x = parent[parent[x]]
                return x

            for y in range(a, b):
                if not member[y]:
                    continue
                at = np.minimum(np.searchsorted(values, sets[y]), len(values) - 1)
                at = at[values[at] == sets[y]]
                frame, rest = int(common[at].sum()), at[~common[at]]
                lo, width = first[rest], times[rest]
                spots = np.repeat(lo - np.append(0, np.cumsum(width)[:-1]), width) + np.arange(width.sum()) if len(rest) else np.zeros(0, np.int64)
                most = np.bincount(owner[spots], minlength=len(asking)) + np.minimum(often, frame)
                for u in np.flatnonzero(100 * most >= percent * (n + len(sets[y]) - most)):
                    x, z = root(roots[asking[u]]), root(roots[y])
                    if x == z:
                        continue
                    other = sets[asking[u]]
                    place = np.searchsorted(sets[y], other)
                    both = int((sets[y][np.minimum(place, len(sets[y]) - 1)] == other).sum())
                    if compared is not None:
                        compared.append(1)
                    if 100 * both >= percent * (len(other) + len(sets[y]) - both):
                        parent[max(x, z)] = min(x, z)
                        out.append((ids[asking[u]], ids[y]))
        yield _edges(out)

    return lambda batches: _grouped(batches, process)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = 80,
    perms: int = 128,
    rows: int = 4,
    block: int = 4096,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row: the groups that links of similar texts form.

    Two documents are linked if the Jaccard similarity of their sets of `shingle`-word shingles is
    `percent` or more; component_id is the least id that links reach. Equal sets are one class
    from the start. SuperMinHash signatures are cut into perms / rows bands; at similarity 0.8 the
    32 bands of 4 miss a pair once in 2e7. Each class first meets the least members of its buckets.
    What then lies in one bucket but in different components is sieved by sizes and signatures
    inside the bucket (six standard deviations below the threshold) into groups in question;
    in these all members outside of the group's largest component are held against all members,
    in blocks: first by sizes and signatures, and whole sets only of those that have a plausible partner in
    their block. Every link is confirmed on whole sets; no step gives out all pairs of a group.
    Buckets of over `block` members are first split by a further band (a linked pair shares one
    with the same certainty); what is still larger is compared as pairs of blocks.

    Ids are whole numbers. Null text and text without words: n_shingles 0, linked with nothing. Null id: linked with
    nothing, component_id and kept null. A repeated id counts as one document of several texts:
    each of its rows is returned, all in one component. Other columns are not read.
    """
    least = percent / 100 - 6 * (percent / 100 * (1 - percent / 100) / perms) ** 0.5
    source = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.encode(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), "UTF-8").alias("text")
    )
    sketched = durable(
        source.mapInArrow(_sketcher(shingle, perms, rows), "id long, n_shingles long, digest binary, bands array<long>, sign binary"),
        "sketches",
    )
    known = sketched.where("id is not null and n_shingles > 0")
    classes = known.groupBy("digest").agg(F.min(F.struct("id", "n_shingles", "bands", "sign")).alias("x")).select("digest", "x.*")
    classes = durable(classes, "classes")
    reps = classes.select("id", "n_shingles", "sign")
    buckets = classes.select(F.explode("bands").alias("key"), "id")
    members = durable(buckets.join(_shared(buckets), "key"), "members")
    starred = members.where("id <> least_id").select(F.col("least_id").alias("a"), F.col("id").alias("b")).distinct()

    def plausible(pairs: DataFrame) -> DataFrame:
        x = reps.select(F.col("id").alias("a"), F.col("n_shingles").alias("na"), F.col("sign").alias("sa"))
        y = reps.select(F.col("id").alias("b"), F.col("n_shingles").alias("nb"), F.col("sign").alias("sb"))
        sized = pairs.join(x, "a").join(y, "b").where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
        return sized.select("a", "b", "sa", "sb").mapInArrow(_agreeing(least), "a long, b long")

    likely = durable(plausible(starred), "likely")
    # Whole sets only of classes that share a bucket with another one; texts move once.
    wanted = members.select("id").distinct()
    sets = durable(source.where("id is not null").join(wanted, "id").mapInArrow(_setter(shingle), "id long, hashes binary"), "sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        x = sets.select(F.col("id").alias("a"), F.col("hashes").alias("ha"))
        y = sets.select(F.col("id").alias("b"), F.col("hashes").alias("hb"))
        return pairs.join(y, "b").join(x, "a").select("a", "b", "ha", "hb").mapInArrow(_confirmer(percent), "a long, b long")

    # A repeated id is one document, so the classes of its texts are linked from the start.
    own = known.select("id", "digest").join(classes.select("digest", F.col("id").alias("rep")), "digest").select("id", "rep")
    many = own.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("hi")).where("a <> hi")
    given = own.join(many, "id").where("a <> rep").select("a", F.col("rep").alias("b"))

    links = durable(confirmed(likely.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")).unionByName(given), "links")
    roots = components(links)
    ra = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    rb = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    apart = likely.join(ra, "a", "left").join(rb, "b", "left").where("coalesce(ra, a) <> coalesce(rb, b)").select("a", "b")
    more = durable(confirmed(apart), "links")
    first, links = links, links.unionByName(more)
    roots = components(links)
    forget(likely)

    def rooted(df: DataFrame) -> DataFrame:
        return df.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))

    def mixed(df: DataFrame) -> DataFrame:
        """Members of the buckets that hold several components, with the buckets' sizes."""
        found = df.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("root").alias("lo"), F.max("root").alias("hi"))
        return durable(df.join(found.where("lo <> hi").select("key", "size"), "key"), "mixed")

    spread = mixed(rooted(members.select("key", "id")))
    cells = spread.where(F.col("size") <= block).select("key", "id", "root")
    large = spread.where(F.col("size") > block)
    if not large.isEmpty():
        both = (F.least("key", "other"), F.greatest("key", "other"))
        further = large.join(classes.select("id", "bands"), "id").select("id", "root", "key", F.explode("bands").alias("other"))
        split = mixed(further.where("other <> key").select(F.xxhash64(*both).alias("key"), "id", "root").distinct())
        parts = F.ceil(F.col("size") * 2 / block)
        pairs = split.where(F.col("size") > block).withColumn("i", F.pmod(F.xxhash64("id"), parts))
        pairs = pairs.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
        cells = cells.unionByName(split.where(F.col("size") <= block).select("key", "id", "root")).unionByName(
            pairs.select(F.xxhash64("key", F.least("i", "j"), F.greatest("i", "j")).alias("key"), "id", "root")
        )
    asked = cells.join(reps, "id").select("key", "id", "root", "n_shingles", "sign").repartition("key").sortWithinPartitions("key")
    forest = asked.mapInArrow(_plausible_forest(percent, least), "a long, b long").distinct()

    # Groups in question: askers are all outside of a group's largest component.
    groups = rooted(components(forest).select(F.col("node").alias("id"), F.col("root").alias("group")))
    groups = durable(groups, "groups")
    parts = groups.groupBy("group", "root").agg(F.count(F.lit(1)).alias("n"))
    main = parts.groupBy("group").agg(F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("total"))
    main = main.select("group", F.col("main.root").alias("main"), F.ceil(F.col("total") / 1024).alias("spans"), F.ceil((F.col("total") - F.col("main.n")) / 512).alias("lots"))
    placed = groups.join(main, "group").withColumn("hash", F.xxhash64("id"))
    asking = placed.where("root <> main").select(
        "group", "id", "root", F.pmod("hash", "lots").alias("lot"), F.explode(F.expr("sequence(0L, spans - 1)")).alias("span"), F.lit(False).alias("member")
    )
    asked = placed.select(
        "group", "id", "root", F.explode(F.expr("sequence(0L, lots - 1)")).alias("lot"), F.pmod("hash", "spans").alias("span"), F.lit(True).alias("member")
    )
    cells = asking.unionByName(asked).select(F.xxhash64("group", "lot", "span").alias("cell"), "member", "id", "root")
    signed = cells.join(reps, "id").select("cell", "member", "id", "root", "n_shingles", "sign").repartition("cell").sortWithinPartitions("cell", "member")
    cells = durable(signed.mapInArrow(_sieved(percent, least), "cell long, member boolean, id long, root long"), "cells")
    held = cells.join(sets, "id").select("cell", "member", "id", "root", "hashes").repartition("cell").sortWithinPartitions("cell", "member")
    found = durable(held.mapInArrow(_block_links(percent), "a long, b long"), "links")
    if not found.isEmpty():
        roots = components(links.unionByName(found))
    # The result reads the sketches, the classes and the roots alone.
    forget(members, sets, groups, cells, first, more, found)

    placed = (
        sketched.select("id", "n_shingles", "digest")
        .join(classes.select("digest", F.col("id").alias("rep")), "digest", "left")
        .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .withColumn("component_id", F.when(F.col("id").isNotNull(), F.coalesce("root", "rep", "id")))
    )
    return placed.select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id", (F.col("id") == F.col("component_id")).alias("kept")
    )


def _shared(buckets: DataFrame) -> DataFrame:
    return buckets.groupBy("key").agg(F.min("id").alias("least_id"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "least_id")
