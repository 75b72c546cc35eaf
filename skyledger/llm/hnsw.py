"""Embedding near-duplicates by hierarchical navigable small-world graphs, one per shard.

Equal vectors are one node. Nodes are dealt to shards by a hash; each shard builds its graph, layer by layer from the
top, and every block of nodes queries every shard. A search is best-first with a beam; it runs for many queries at
once. A beam that is full of links widens twofold for its query until it is not, so no number of links is a cap. Each
block audits itself: it compares what the graph found with all vectors of the shard, for as many queries as it takes to
see a fixed number that do have links, or for all. The mean share of a query's links that was found, of queries with few
links and of those with many, must be at least ``recall``, or the beam of the block widens; links that only the audit saw
are kept. Links are checked by cosine in double precision on the original vectors, and components are joined over all
shards.

Memory: a shard has a bounded number of nodes and of components, so there are more of them where the table is larger. Its
graph is a table with a row for each node and layer. A task holds one graph and one block of queries, which stream past it;
what it works with and what it returns is cut to a fixed size, whatever the number of links or the width of a beam.

Vectors that are null, zero, or hold null or non-finite components link with nothing, nor do those of another length.
Rows with a null id are in no class but are returned. Rows that share an id are one vector with several values.
Each value is a node of its own, keyed by a hash of it and its least id; an id has the most links of any of its values.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, saved
from .components import components
from .vectors import matrix, usable

THRESHOLD = 0.95
SHARDS, BLOCK_ROWS = 4, 4_096
DEGREE, BUILD_BEAM, BEAM, RECALL, AUDITED = 16, 48, 32, 0.99, 64
#: Extra neighbours that a node may get so that every node can be reached.
BRIDGES = 4
#: Nodes of a shard and components of its vectors, on average at most: beyond that there are more shards. Components of a block.
SHARD_ROWS, SHARD_CELLS, BLOCK_CELLS = 100_000, 6_400_000, 1 << 20
#: Bytes that a step of a search works with, about; pairs that are returned at once.
WORK, PAIRS = 32_000_000, 50_000
#: In place of a layer, for rows that are queries: they come after all layers.
QUERY = 1_000


def _dots(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Products of rows ``i`` of one matrix with rows ``j`` of another, a piece at a time."""
    out = np.empty(len(i), np.float32)
    step = max(1, WORK // (32 * a.shape[1]))
    for lo in range(0, len(i), step):
        out[lo : lo + step] = np.einsum("nd,nd->n", a[i[lo : lo + step]], b[j[lo : lo + step]])
    return out


def _at_once(nodes: int, beam: int, degree: int) -> int:
    """Queries whose walk through a layer takes ``WORK`` bytes."""
    return max(1, WORK // (nodes + 48 * (beam + max(4, beam // 8) * degree)))


def search(x: np.ndarray, adj: np.ndarray, place: np.ndarray, q: np.ndarray, entry: np.ndarray, beam: int):
    """The ``beam`` nodes nearest to each query that a best-first walk finds: ids (-1: none), best first, and similarities.

    A step opens the best eighth of a beam at once.
    """
    step = _at_once(len(adj), min(beam, len(adj)), adj.shape[1])
    if step >= len(q):
        return _walk(x, adj, place, q, entry, beam)
    parts = [_walk(x, adj, place, q[lo : lo + step], entry[lo : lo + step], beam) for lo in range(0, len(q), step)]
    return np.concatenate([ids for ids, _ in parts]), np.concatenate([sims for _, sims in parts])


def _walk(x: np.ndarray, adj: np.ndarray, place: np.ndarray, q: np.ndarray, entry: np.ndarray, beam: int):
    n, width = len(q), min(beam, len(adj))
    spread = max(4, width // 8)
    ids = np.full((n, width), -1, np.int32)
    sims = np.full((n, width), -np.inf, np.float32)
    seen = np.zeros((n, len(adj)), bool)
    rows = np.arange(n)[:, None]
    entry = entry[:, :width]
    ids[:, : entry.shape[1]] = entry
    sims[:, : entry.shape[1]] = _dots(q, np.repeat(np.arange(n), entry.shape[1]), x, entry.reshape(-1)).reshape(entry.shape)
    seen[rows, place[entry]] = True
    wide_open = np.zeros((n, width), bool)
    wide_open[:, : entry.shape[1]] = True
    while True:
        rank = np.where(wide_open, sims, -np.inf)
        active = np.flatnonzero(np.isfinite(rank.max(axis=1)))
        if not len(active):
            order = np.argsort(-sims, axis=1, kind="stable")
            return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        k = min(spread, width)
        best = np.argpartition(-rank[active], k - 1, axis=1)[:, :k] if k < width else np.tile(np.arange(width), (len(active), 1))
        good = np.isfinite(np.take_along_axis(rank[active], best, 1))
        wide_open[active[:, None], best] = False
        chosen = ids[active[:, None], best]
        near = adj[place[np.where(good, chosen, ids[active, :1])]].reshape(len(active), -1)
        near = np.where(np.repeat(good, adj.shape[1], axis=1), near, -1)
        near = np.sort(near, axis=1)
        new = near >= 0
        new[:, 1:] &= near[:, 1:] != near[:, :-1]
        at = place[np.maximum(near, 0)]
        new &= ~seen[active[:, None], at]
        r, c = np.nonzero(new)
        seen[active[r], at[r, c]] = True
        found = np.full(near.shape, -np.inf, np.float32)
        found[r, c] = _dots(q, active[r], x, near[r, c])
        all_ids = np.concatenate([ids[active], near], axis=1)
        all_sims = np.concatenate([sims[active], found], axis=1)
        all_open = np.concatenate([wide_open[active], new], axis=1)
        top = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
        sims[active] = np.take_along_axis(all_sims, top, 1)
        ids[active] = np.where(np.isfinite(sims[active]), np.take_along_axis(all_ids, top, 1), -1)
        wide_open[active] = np.take_along_axis(all_open, top, 1) & np.isfinite(sims[active])


def diverse(x: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Of candidates, best first, those nearer to the base than to any chosen one; then the best of the others."""
    n, c = ids.shape
    step = max(1, WORK // (4 * c * (c + x.shape[1])))
    if step < n:
        return np.concatenate([diverse(x, ids[lo : lo + step], sims[lo : lo + step], most) for lo in range(0, n, step)])
    v = x[np.maximum(ids, 0)]
    cross = v @ v.transpose(0, 2, 1)
    kept = np.zeros((n, c), bool)
    closest = np.full((n, c), -np.inf, np.float32)
    count = np.zeros(n, np.int64)
    for j in range(c):
        ok = (ids[:, j] >= 0) & (count < most) & (sims[:, j] > closest[:, j])
        kept[:, j] = ok
        count += ok
        closest = np.where(ok[:, None], np.maximum(closest, cross[:, j, :]), closest)
    order = np.argsort(np.where(ids < 0, 2, np.where(kept, 0, 1)), axis=1, kind="stable")[:, :most]
    out = np.take_along_axis(ids, order, 1)
    return np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1) if out.shape[1] < most else out


def _sorted(ids: np.ndarray, sims: np.ndarray):
    order = np.argsort(-sims, axis=1, kind="stable")
    sims = np.take_along_axis(sims, order, 1)
    return np.where(np.isfinite(sims), np.take_along_axis(ids, order, 1), -1), sims


def build_layer(x: np.ndarray, nodes: np.ndarray, upper: list, degree: int, beam: int) -> np.ndarray:
    """Neighbours of the nodes of a layer; nodes are added in batches that search what is there already."""
    place = np.full(len(x), -1, np.int64)
    place[nodes] = np.arange(len(nodes))
    adj = np.full((len(nodes), degree), -1, np.int32)
    done = 0
    while done < len(nodes):
        batch = nodes[done : done + max(64, min(done, 1024))]
        q = x[batch]
        inner = q @ q.T
        np.fill_diagonal(inner, -np.inf)
        k = min(len(batch), degree if done else beam)
        mate = np.argsort(-inner, axis=1, kind="stable")[:, :k]
        ids, sims = batch[mate].astype(np.int32), np.take_along_axis(inner, mate, 1)
        if done:
            there = place < done
            entry = descend(x, upper, q) if upper else np.tile(nodes[:1], (len(batch), 1)).astype(np.int32)
            entry = np.where(there[entry] & (place[entry] >= 0), entry, nodes[0])
            found, near = search(x, adj[:done], place, q, entry, beam)
            ids, sims = np.concatenate([ids, found], axis=1), np.concatenate([sims, near], axis=1)
        ids, sims = _sorted(ids, np.where(ids >= 0, sims, -np.inf).astype(np.float32))
        chosen = diverse(x, ids, sims, degree)
        adj[done : done + len(batch)] = chosen
        _link_back(x, adj, place, batch, chosen, degree)
        done += len(batch)
    return adj


def _link_back(x, adj, place, batch, chosen, degree) -> None:
    """Add the batch to the neighbours' own lists, and choose anew where they are full."""
    a, b = np.repeat(batch, chosen.shape[1]), chosen.reshape(-1)
    a, b = a[b >= 0], b[b >= 0]
    sims = _dots(x, a, x, b)
    order = np.lexsort((-sims, b))
    a, b = a[order], b[order]
    head = np.flatnonzero(np.concatenate(([True], np.diff(b) != 0))) if len(b) else np.zeros(0, np.int64)
    nth = np.arange(len(b)) - np.repeat(head, np.diff(np.append(head, len(b))))
    few = nth < 2 * degree
    target = b[head]
    come = np.full((len(target), 2 * degree), -1, np.int32)
    come[(np.cumsum(np.concatenate(([True], np.diff(b) != 0))) - 1)[few] if len(b) else few, nth[few]] = a[few]
    step = max(1, min(1024, WORK // (12 * degree * x.shape[1])))
    for lo in range(0, len(target), step):
        t = target[lo : lo + step]
        ids = np.concatenate([adj[place[t]], come[lo : lo + step]], axis=1)
        ids = -np.sort(-ids, axis=1)
        ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
        sims = np.where(ids >= 0, np.einsum("nd,nkd->nk", x[t], x[np.maximum(ids, 0)]), -np.inf).astype(np.float32)
        adj[place[t]] = diverse(x, *_sorted(ids, sims), degree)


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM) -> list[tuple[np.ndarray, np.ndarray]]:
    """Layers (nodes, neighbours) from the top down; a node's highest layer is drawn from a generator with fixed seed."""
    level = np.floor(-np.log(np.random.default_rng(7).uniform(1e-12, 1, len(x))) / np.log(degree)).astype(int)
    level[0] = level.max()
    layers: list = []
    for at in range(int(level.max()), -1, -1):
        nodes = np.flatnonzero(level >= at)
        nodes = nodes[np.argsort(-level[nodes], kind="stable")]  # those of the layer above come first
        most = degree if at else 2 * degree
        adj = build_layer(x, nodes, layers, most, beam) if len(nodes) > 1 else np.full((len(nodes), most), -1, np.int32)
        layers.append((nodes, _reachable(x, nodes, adj, 2 * degree + BRIDGES)))
    return layers


def _reachable(x: np.ndarray, nodes: np.ndarray, adj: np.ndarray, width: int) -> np.ndarray:
    """The same neighbours in rows of one width, and bridges to nodes that cannot be walked to from the first one."""
    place = np.full(len(x) + 1, len(nodes), np.int64)
    place[nodes] = np.arange(len(nodes))
    place = place[:-1]
    out = np.concatenate([adj, np.full((len(adj), BRIDGES), -1, np.int32)], axis=1)
    seen, used = np.zeros(len(nodes), bool), np.zeros(len(nodes), np.int64)
    front = np.zeros(1, np.int64)
    while True:
        while len(front):
            seen[front] = True
            near = out[front].reshape(-1)
            near = np.unique(place[near[near >= 0]])
            front = near[~seen[near]]
        lost = np.flatnonzero(~seen)
        if not len(lost):
            return np.pad(out, ((0, 0), (0, width - out.shape[1])), constant_values=-1)
        # the nearest node that can be reached and has room; a chain of bridges always has some
        room = np.flatnonzero(seen & (used < BRIDGES))
        by = room[int(np.argmax(x[nodes[room]] @ x[nodes[lost[0]]]))]
        out[by, adj.shape[1] + used[by]] = nodes[lost[0]]
        used[by] += 1
        front = lost[:1]


def descend(x: np.ndarray, layers: list, q: np.ndarray, beam: int = 4) -> np.ndarray:
    """Nodes to enter the layer below the given ones."""
    entry = np.tile(layers[0][0][:1], (len(q), 1)).astype(np.int32)
    for nodes, adj in layers:
        place = np.full(len(x), -1, np.int64)
        place[nodes] = np.arange(len(nodes))
        ids, _ = search(x, adj, place, q, entry, beam)
        entry = np.where(ids >= 0, ids, ids[:, :1])
    return entry


def _truth(x: np.ndarray, q: np.ndarray, own: np.ndarray, least: np.float32):
    """Links (query, node) by all vectors of the shard, for queries in random order, and which queries they are whole for.

    Queries with at most ``BEAM`` links and those with more are told apart; the latter come with a mask of nodes each. Queries
    are added until ``AUDITED`` of the first kind have links, or the block is used up; of the second kind the first
    ``AUDITED`` are kept.
    """
    who, what, known = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], np.zeros(len(q), bool)
    many, masks, few = [np.zeros(0, np.int64)], [np.zeros((0, len(x)), bool)], 0
    order = np.random.default_rng(11).permutation(len(q))
    for lo in range(0, len(q), AUDITED):
        part = order[lo : lo + AUDITED]
        linked = q[part] @ x.T >= least
        itself = np.flatnonzero(own[part] >= 0)
        linked[itself, own[part[itself]]] = False
        n = np.count_nonzero(linked, axis=1)
        some, dense = np.flatnonzero(n <= BEAM), np.flatnonzero(n > BEAM)[: AUDITED - sum(map(len, many))]
        known[part[some]] = known[part[dense]] = True
        some = some[n[some] > 0]
        few += len(some)
        r, c = np.nonzero(linked[some])
        who.append(part[some[r]])
        what.append(c)
        many.append(part[dense])
        masks.append(linked[dense])
        if few >= AUDITED:
            break
    return np.concatenate(who), np.concatenate(what), known, np.concatenate(many), np.concatenate(masks)


def _found(x: np.ndarray, layers: list, q: np.ndarray, asked: np.ndarray, least: np.float32, beam: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links (query, node) that the graph finds for the queries ``asked``, a piece at a time."""
    nodes, adj = layers[-1]
    place = np.full(len(x), -1, np.int64)
    place[nodes] = np.arange(len(nodes))
    step = _at_once(len(x), beam, adj.shape[1])
    for lo in range(0, len(asked), step):
        todo = asked[lo : lo + step]
        entry = descend(x, layers[:-1], q[todo]) if len(layers) > 1 else np.tile(nodes[:1], (len(todo), 1)).astype(np.int32)
        waiting = [(todo, entry, beam)]
        while waiting:
            todo, entry, width = waiting.pop()
            ids, sims = search(x, adj, place, q[todo], entry, width)
            full = (sims[:, -1] >= least) & (width < len(x))
            r, c = np.nonzero((sims >= least) & ~full[:, None])
            yield todo[r], ids[r, c]
            # start again from what was found
            todo, entry, width = todo[full], ids[full], width * 2
            fewer = _at_once(len(x), width, adj.shape[1])
            waiting += [(todo[i : i + fewer], entry[i : i + fewer], width) for i in range(0, len(todo), fewer)]


def audited_links(x: np.ndarray, layers: list, q: np.ndarray, threshold: float, beam: int = BEAM, recall: float = RECALL, own: np.ndarray | None = None):
    """The share of its links found for each audited query that has some, and pairs (query, node) with a similarity of at least ``threshold``, a piece at a time.

    ``own`` is the node that a query is itself (-1: none); that pair is no link to audit. The shares are those of the
    last beam, with which the other queries are asked; the pairs also hold what the audit found.
    """
    least = np.float32(threshold - 1e-5)
    who, what, known, many, masks = _truth(x, q, np.full(len(q), -1) if own is None else own, least)
    key = np.sort(who * len(x) + what)
    row = np.full(len(q), -1)
    row[many] = np.arange(len(many))
    total = np.bincount(who, minlength=len(q))
    total[many] = np.count_nonzero(masks, axis=1)
    linked = np.flatnonzero(total)
    while True:
        # queries whose links are known are asked only to measure
        hit, seen = np.zeros(len(key), bool), np.zeros_like(masks)
        for a, b in _found(x, layers, q, linked, least, beam):
            dense = row[a] >= 0
            seen[row[a[dense]], b[dense]] = True
            pair = a[~dense] * len(x) + b[~dense]
            at = np.searchsorted(key, pair)
            at, pair = at[at < len(key)], pair[at < len(key)]
            hit[at[key[at] == pair]] = True
        found = np.bincount(key // len(x), hit, len(q))
        found[many] = np.count_nonzero(seen & masks, axis=1)
        share, dense = found[linked] / total[linked], total[linked] > BEAM
        # a few queries with very many links do not speak for the others
        reached = min((float(s.mean()) for s in (share[dense], share[~dense]) if len(s)), default=1.0)
        if reached >= recall or beam >= len(x) or known.all():
            break
        beam *= 2

    def pairs():
        yield who, what
        for i, mask in zip(many, masks, strict=True):
            yield np.full(np.count_nonzero(mask), i), np.flatnonzero(mask)
        yield from _found(x, layers, q, np.flatnonzero(~known), least, beam)

    return share, pairs()


def links_within(x: np.ndarray, layers: list, q: np.ndarray, threshold: float, beam: int = BEAM, recall: float = RECALL, own: np.ndarray | None = None):
    """The pairs of ``audited_links`` at once, and the shares."""
    share, pairs = audited_links(x, layers, q, threshold, beam, recall, own)
    who, what = zip(*pairs, strict=True)
    return np.concatenate(who), np.concatenate(what), share


def _unit(v: np.ndarray) -> np.ndarray:
    out = np.empty(v.shape, np.float32)
    step = max(1, WORK // (32 * v.shape[1]))
    for lo in range(0, len(v), step):
        part = v[lo : lo + step].astype(float)
        part = part / np.abs(part).max(axis=1, keepdims=True)
        out[lo : lo + step] = part / np.linalg.norm(part, axis=1, keepdims=True)
    return out


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = a.astype(float), b.astype(float)
    a, b = a / np.abs(a).max(axis=1, keepdims=True), b / np.abs(b).max(axis=1, keepdims=True)
    return np.einsum("nd,nd->n", a, b) / np.sqrt(np.einsum("nd,nd->n", a, a) * np.einsum("nd,nd->n", b, b))


def _packed(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    rows = np.ascontiguousarray(rows)
    ends = np.arange(len(rows) + 1, dtype=np.int32) * (rows.shape[1] * rows.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows)])


def _unpacked(column: pa.Array, dtype) -> np.ndarray:
    """Binary values of one length, none null, as a matrix."""
    n = len(column)
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + n + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(dtype).reshape(n, -1)


def _runs(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Batches cut where a key changes, each with its key."""
    for batch in batches:
        if batch.num_rows:
            k = np.stack([batch.column(c).to_numpy() for c in key])
            cuts = [0, *(np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for lo, hi in itertools.pairwise(cuts):
                yield tuple(k[:, lo].tolist()), batch.slice(lo, hi - lo)


def _blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches put together or cut to the same number of rows; the last may have fewer."""
    have, n = [], 0
    for batch in batches:
        while batch.num_rows:
            have.append(batch.slice(0, rows - n))
            batch, n = batch.slice(rows - n), n + have[-1].num_rows
            if n == rows:
                yield have
                have, n = [], 0
    if have:
        yield have


def _numbers(n: int):
    return F.sequence(F.lit(0), F.lit(n - 1))


def asked_links(nodes: DataFrame, n_nodes: int, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Links (a, b), a < b, between nodes (vec_id, v, d), found once or twice; and a row of each block of queries without a link.

    That row has the number of its audited queries with links, and the sum over them of the share that the graph found.
    """
    whole = F.forall("v", lambda x: x.cast("float").cast("double") == x)
    cells, single = nodes.agg(F.sum(F.col("d").cast("long")), F.every(whole)).first()
    # vectors that were made of single floats travel as such
    dtype = np.float32 if single else np.float64
    shards = max(SHARDS, -(-n_nodes // SHARD_ROWS), -(-(cells or 0) // SHARD_CELLS))
    # more partitions than groups, so that few groups share one
    dealt = lambda rows, groups, key: rows.repartition(min(4_096, max(32, 2 * groups)), *key)
    nodes = dealt(nodes.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")), shards, ["shard", "d"])

    def index(frame):
        ids = frame.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, given = ids[order], matrix(frame.column("v"))
        v = np.empty(given.shape, dtype)
        for lo in range(0, len(v), 8_192):
            v[lo : lo + 8_192] = given[order[lo : lo + 8_192]]
        layers = build(_unit(v))
        # nodes are numbered as in the lowest layer, so those of any other come first
        nodes = layers[-1][0]
        place = np.empty(len(nodes), np.int32)
        place[nodes] = np.arange(len(nodes))
        out = []
        for layer, (here, adj) in enumerate(reversed(layers)):
            for lo in range(0, len(here), 8_192):
                edges, mine = adj[lo : lo + 8_192], here[lo : lo + 8_192]
                n = len(mine)
                at = [np.full(n, frame.column("shard")[0].as_py()), np.full(n, frame.column("d")[0].as_py()), np.full(n, layer), np.arange(lo, lo + n)]
                base = [pa.array(ids[mine]), _packed(v[mine])] if layer == 0 else [pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())]
                columns = [*(pa.array(x.astype(np.int32)) for x in at), *base, _packed(np.where(edges >= 0, place[edges], -1).astype(np.int32))]
                out.append(pa.RecordBatch.from_arrays(columns, schema=graph_schema))
        release()
        return pa.Table.from_batches(out)

    graph_schema = pa.schema([(c, pa.int32()) for c in ("shard", "d", "layer", "pos")] + [("vec_id", pa.int64()), ("v", pa.binary()), ("edges", pa.binary())])
    graphs = saved(nodes.groupBy("shard", "d").applyInArrow(index, "shard int, d int, layer int, pos int, vec_id long, v binary, edges binary"), "graphs")

    answer = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("queries", pa.int64()), ("found", pa.float64())])

    def answers(graph, asked, d):
        """Links of the nodes asked in the graph: batches of links, and a row without one for each block."""
        ids, v = np.concatenate(graph.pop("vec_id")), np.concatenate(graph.pop("v"))
        layers = [np.concatenate(graph.pop(at)) for at in sorted(graph, reverse=True)]
        layers = [(np.arange(len(adj)), adj) for adj in layers]
        x, rank = _unit(v), np.argsort(ids)
        for block in _blocks(asked, max(1, min(BLOCK_ROWS, BLOCK_CELLS // d))):
            mine = np.concatenate([b.column("vec_id").to_numpy() for b in block])
            w = np.concatenate([_unpacked(b.column("v"), dtype) for b in block])
            at = rank[np.minimum(np.searchsorted(ids, mine, sorter=rank), len(ids) - 1)]
            share, pairs = audited_links(x, layers, _unit(w), threshold, recall=recall, own=np.where(ids[at] == mine, at, -1))
            yield pa.RecordBatch.from_pydict({"a": [None], "b": [None], "queries": [len(share)], "found": [float(share.sum())]}, schema=answer)
            step, good, n = max(1, WORK // (32 * d)), [], 0
            for who, what in pairs:
                for lo in range(0, len(who), step):
                    p, q = who[lo : lo + step], what[lo : lo + step]
                    ok = (mine[p] != ids[q]) & (_cosines(w[p], v[q]) >= threshold)
                    good.append((mine[p[ok]], ids[q[ok]]))
                    n += len(good[-1][0])
                    if n >= PAIRS:
                        yield linked(good)
                        good, n = [], 0
            if n:
                yield linked(good)

    def linked(pairs):
        a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.float64())], schema=answer)

    def ask(batches):
        for _, group in itertools.groupby(_runs(batches, [*key, "layer"]), lambda run: run[0][:-1]):
            graph: dict = {}
            for (*_, d, layer), batch in group:
                if layer == QUERY:
                    # a shard without vectors of this length has nothing to ask
                    if graph:
                        yield from answers(graph, itertools.chain([batch], (b for _, b in group)), d)
                    break
                graph.setdefault(layer, []).append(_unpacked(batch.column("edges"), np.int32))
                if layer == 0:
                    graph.setdefault("vec_id", []).append(batch.column("vec_id").to_numpy())
                    graph.setdefault("v", []).append(_unpacked(batch.column("v"), dtype))
        release()

    key = ["shard", "by", "d"]
    given = graphs.withColumn("by", F.explode(_numbers(shards)))
    asked = graphs.where("layer = 0").withColumn("by", F.col("shard")).withColumn("shard", F.explode(_numbers(shards)))
    asked = asked.withColumns({"layer": F.lit(QUERY), "pos": F.lit(0), "edges": F.lit(None).cast("binary")})
    both = dealt(given.unionByName(asked), shards * shards, key).sortWithinPartitions(*key, "layer", "pos", "vec_id")
    return both.mapInArrow(ask, "a long, b long, queries long, found double")


def links(nodes: DataFrame, n_nodes: int, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Links (a, b), a < b, between nodes (vec_id, v, d)."""
    return asked_links(nodes, n_nodes, threshold, recall).where("a is not null").select("a", "b").distinct()


def measured_recall(nodes: DataFrame, n_nodes: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[float | None, int]:
    """Mean share of an audited query's links in a shard that the graphs found (none: no links), and the number of such queries."""
    found, queries = asked_links(nodes, n_nodes, threshold, recall).agg(F.sum("found"), F.sum("queries")).first()
    return (found / queries if queries else None), queries or 0


def near_duplicates(table: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Per vector: ``n_links``, ``component_id`` and ``kept``."""
    rows = saved(usable(table), "vectors")
    same = rows.groupBy("v").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    same = saved(same.select("v", "first", "copies", F.size("v").alias("d"), F.xxhash64("first", "v").alias("node")), "nodes")
    members = saved(rows.join(same.select("v", "node"), "v").select("vec_id", "node"), "members")
    nodes = same.select(F.col("node").alias("vec_id"), "v", "d")
    found = saved(links(nodes, nodes.count(), threshold, recall), "links")
    both = found.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(found.select(F.col("b").alias("node"), F.col("a").alias("other")))
    weight = same.select(F.col("node").alias("other"), "copies")
    count = both.join(weight, "other").groupBy("node").agg(F.sum("copies").alias("n"))
    # the values of an id are in one component
    several = members.groupBy("vec_id").agg(F.min("node").alias("a"), F.max("node").alias("most")).where("a <> most").drop("most")
    label = saved(components(found.unionByName(members.join(several, "vec_id").where("a <> node").select("a", F.col("node").alias("b")))), "labels")
    least = same.select("node", "first").join(label, "node").groupBy("label").agg(F.min("first").alias("least"))
    known = same.select("node", "first", "copies").join(count, "node", "left").join(label, "node", "left").join(least, "label", "left")
    known = known.select("node", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("least", "first").alias("c"))
    out = members.join(known, "node").groupBy("vec_id").agg(F.max("n").alias("n"), F.min("c").alias("c"))
    ids = table.select(F.col("vec_id").cast("long").alias("vec_id")).join(out, "vec_id", "left")
    return ids.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "vec_id").alias("component_id")).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
