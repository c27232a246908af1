"""Similar documents by a token-group matrix.

A document is its set of 5-word shingles.  Documents are first partitioned into groups of similar
ones (equal smallest shingles under several orders), in which links are found exactly.  Linked
documents and leftovers form the groups of the matrix: for every token, the groups in whose union
it lies.  A query document then meets only groups that share one of its rarest shingles (a prefix
long enough that a linked document must share one), its overlap with the group's token union bounds
its overlap with any member, and only groups whose bound qualifies are opened and compared member by
member.  Documents that are already connected never open each other's groups, and under a shingle of
many documents those not yet connected first meet one group of the largest component there, so a large
group of near copies costs work in proportion to its size, and no pairs of a group are ever written out.

Shingles are named by 64 bits, sets by 63; equal sets are one node.

Defined results
    NULL or empty text, or no words: empty set, no links, own component.  Fewer words than a
    shingle: the whole sequence is the only shingle.  NULL doc_id: takes part, and a component's id
    is its smallest non-NULL doc_id (NULL if there is none).  Repeated rows: each is a row of the
    result.  Empty table: empty result.  Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm import common as C

U64 = np.uint64


@dataclass(frozen=True)
class JoinParams:
    width: int = 5
    #: Link when 100 * intersection >= percent * union.
    percent: int = 75
    #: Orders under which the two smallest shingles put documents into a first group.
    orders: int = 2
    #: Members of a group that are held and compared at once.
    block: int = 512
    #: Queries that meet one group in one task.
    queries: int = 1_000
    #: A shingle of this many documents goes to the end of every order; counted over what tasks
    #: met in ``met`` documents or more, ``counted_at_once`` shingles at a time.
    common_documents: int = 12
    met: int = 2
    counted_at_once: int = 2_000_000
    #: A shingle in the prefixes of more groups than this goes there too, and prefixes are redone.
    crowded_groups: int = 40
    redo: int = 1
    #: Rows times further components of a shingle above which it is crowded, and turns in which components
    #: under crowded shingles are joined before queries meet all groups.
    crowded_pairs: int = 5_000
    early: int = 3


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle names of each document of a chunk; A-Z read as a-z."""
    low = C.LOWER[data]
    starts, ends, at = C.words(low, offsets)
    hashes = C.word_hashes(low, starts, ends)
    grams = C.sequence_hashes(hashes, width)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(grams[a:b - width + 1]))
        elif b > a:
            out.append(C.sequence_hashes(hashes[a:b], b - a, 7 + b - a))
        else:
            out.append(np.zeros(0, U64))
    return out


def node_of(tokens: np.ndarray) -> int:
    """Name of a set; the lowest bit is left free for a flag."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True) & ~1


def _keys(tokens: np.ndarray, orders: int) -> list[int]:
    """A name of the two smallest shingles under each order."""
    out = []
    for j in range(orders):
        ranked = C.mix(tokens + C._COEF[300 + j])
        two = np.sort(np.partition(ranked, 1)[:2]) if len(ranked) > 1 else np.r_[ranked, ranked]
        out.append(int(C.signed(C.mix(two[:1] * C._COEF[310] + two[1:] * C._COEF[311] + U64(j)))[0]))
    return out


def describe(docs: DataFrame, params: JoinParams) -> DataFrame:
    """A row for every document: doc_id, n, node (NULL for the empty set) and the group keys.

    Further rows, with ``common`` set, count shingles that a task met in several documents; they
    are sums over all documents, less what single tasks met only once or twice."""
    kinds = docs.schema["doc_id"].dataType.simpleString()
    names = [f"k{j}" for j in range(params.orders)]
    columns = ["doc_id", "n", "node", *names, "common"]

    def counted(tokens: list[np.ndarray], kind) -> pa.RecordBatch:
        token, n = np.unique(np.concatenate(tokens), return_counts=True)
        often = n >= params.met
        rows = int(often.sum())
        none = [pa.nulls(rows, t) for t in (kind, pa.int64(), *[pa.int64()] * len(names))]
        return pa.RecordBatch.from_arrays([none[0], pa.array(n[often].astype(np.int64)), *none[1:], pa.array(C.signed(token[often]))], columns)

    def run(batches):
        held, size, kind = [], 0, pa.int64()
        for part, data, offsets in C.chunks(batches, "text"):
            sets = shingle_sets(data, offsets, params.width)
            keys = [_keys(s, params.orders) if len(s) else [None] * params.orders for s in sets]
            ids = part.column(part.schema.get_field_index("doc_id"))
            kind = ids.type
            yield pa.RecordBatch.from_arrays([
                ids, pa.array([len(s) for s in sets], pa.int64()), pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()),
                *[pa.array([row[j] for row in keys], pa.int64()) for j in range(len(names))], pa.nulls(part.num_rows, pa.int64())], columns)
            held += [s for s in sets if len(s)]
            size += sum(map(len, sets))
            if size >= params.counted_at_once:
                yield counted(held, kind)
                held, size = [], 0
        if held:
            yield counted(held, kind)

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kinds}, n long, node long, " + ", ".join(f"{k} long" for k in names) + ", common long")


def sets_of(docs: DataFrame, nodes: DataFrame, params: JoinParams) -> DataFrame:
    """(node, tokens) for the given nodes: a bounded bitmap drops most others before the shuffle,
    the caller's join on node drops the rest.  A task gives each set once."""
    marks = C.bitmap(nodes.select(F.shiftright("node", 1).alias("node")), "node")

    def run(batches):
        C.release()
        seen = C.Seen()
        for _, data, offsets in C.chunks(batches, "text"):
            sets = [s for s in shingle_sets(data, offsets, params.width) if len(s)]
            names = np.array([node_of(s) for s in sets], np.int64)
            hit = C.in_bitmap(marks, (names >> 1).view(U64)) if len(names) else []
            chosen = [(n, s.tobytes()) for n, s, h in zip(names.tolist(), sets, hit) if h and not seen.again(n)]
            yield pa.RecordBatch.from_pydict({"node": pa.array([c[0] for c in chosen], pa.int64()), "tokens": pa.array([c[1] for c in chosen], pa.binary())})

    return docs.select("text").mapInArrow(run, "node long, tokens binary")


# ---------------------------------------------------------------------------------------
# exact comparison inside one task
# ---------------------------------------------------------------------------------------


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of 0/1 blocks over the tokens both sides have."""
    out = np.zeros((len(left), len(right)), np.float32)
    if not left or not right:
        return out.astype(np.int64)
    a, b = np.concatenate(left), np.concatenate(right)
    both = np.intersect1d(a, b)
    ia, ib = np.searchsorted(both, a), np.searchsorted(both, b)
    ka = np.flatnonzero((ia < len(both)) & (both[np.minimum(ia, len(both) - 1)] == a)) if len(both) else np.zeros(0, int)
    kb = np.flatnonzero((ib < len(both)) & (both[np.minimum(ib, len(both) - 1)] == b)) if len(both) else np.zeros(0, int)
    oa = np.repeat(np.arange(len(left)), [len(x) for x in left])[ka]
    ob = np.repeat(np.arange(len(right)), [len(x) for x in right])[kb]
    ta, tb = ia[ka], ib[kb]
    wide = 4096
    if len(both) > wide:
        sa, sb = np.argsort(ta, kind="stable"), np.argsort(tb, kind="stable")
        oa, ta, ob, tb = oa[sa], ta[sa], ob[sb], tb[sb]
    for start in range(0, len(both), wide):
        wa = slice(*np.searchsorted(ta, [start, start + wide])) if len(both) > wide else slice(None)
        wb = slice(*np.searchsorted(tb, [start, start + wide])) if len(both) > wide else slice(None)
        size = min(wide, len(both) - start)
        x, y = np.zeros((len(left), size), np.float32), np.zeros((len(right), size), np.float32)
        x[oa[wa], ta[wa] - start] = 1
        y[ob[wb], tb[wb] - start] = 1
        out += x @ y.T
    return out.astype(np.int64)


def linked(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    common = overlaps(left, right)
    union = np.array([len(x) for x in left])[:, None] + np.array([len(x) for x in right])[None] - common
    return 100 * common >= percent * union


def _unpack(table: pa.Table, node: str, tokens: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct nodes of a group with their sets."""
    names, first = np.unique(table[node].to_numpy(), return_index=True)
    column = table[tokens]
    return names, [np.frombuffer(column[int(i)].as_py(), U64) for i in first]


_EDGES = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _links_inside(percent: int):
    """A spanning forest of the links of one group."""

    def run(key, table):
        nodes, sets = _unpack(table, "node", "tokens")
        u, v = [], []
        if len(nodes) > 1:
            link = linked(sets, sets, percent)
            left = np.ones(len(nodes), bool)
            for i in range(len(nodes)):
                if not left[i]:
                    continue
                left[i] = False
                front = np.array([i])
                while len(front):
                    reach = np.flatnonzero(link[front].any(0) & left)
                    left[reach] = False
                    u += [int(nodes[i])] * len(reach)
                    v += nodes[reach].tolist()
                    front = reach
        return pa.Table.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], schema=_EDGES)

    return run


def _open_group(percent: int):
    """Queries against one group: the token union bounds first, then members of each component."""

    def run(key, members, queries):
        u, v = [], []
        if members.num_rows and queries.num_rows:
            nodes, sets = _unpack(members, "member", "member_tokens")
            comps = dict(zip(members["member"].to_pylist(), members["member_comp"].to_pylist()))
            comp = np.array([comps[n] for n in nodes.tolist()])
            asked, wanted = _unpack(queries, "node", "tokens")
            union = np.unique(np.concatenate(sets))
            bound = overlaps(wanted, [union])[:, 0]
            sizes = np.array([len(w) for w in wanted])
            open_for = np.flatnonzero(100 * bound >= percent * sizes)
            for start in range(0, len(open_for), 512):
                some = open_for[start:start + 512]
                link = linked([wanted[i] for i in some], sets, percent)
                for row, i in enumerate(some.tolist()):
                    hit = np.flatnonzero(link[row])
                    # one link to each component is enough to join it
                    one = hit[np.unique(comp[hit], return_index=True)[1]]
                    u += [int(asked[i])] * len(one)
                    v += nodes[one].tolist()
        return pa.Table.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], schema=_EDGES)

    return run


# ---------------------------------------------------------------------------------------
# components
# ---------------------------------------------------------------------------------------


def components(edges: DataFrame, scratch: C.Scratch, name: str) -> DataFrame:
    """(node, root): equal roots for connected nodes.  Each round every node joins its smallest
    neighbour and the graph is contracted; names are random, so it shrinks by a constant factor."""
    current = scratch.keep(edges.where("u <> v").distinct(), f"{name}-edges0")
    maps = []
    while not current.isEmpty():
        i = len(maps)
        both = current.select("u", "v").union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        maps.append(scratch.keep(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("r")), f"{name}-map{i}"))
        to = lambda c: maps[-1].select(F.col("u").alias(c), F.col("r").alias(f"{c}r"))
        following = current.join(to("u"), "u").join(to("v"), "v").where("ur <> vr")
        following = scratch.keep(following.select(F.col("ur").alias("u"), F.col("vr").alias("v")).distinct(), f"{name}-edges{i + 1}")
        scratch.drop(f"{name}-edges{i}")
        current = following
    if not maps:
        return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    out = maps[0].select(F.col("u").alias("node"), F.col("r").alias("root"))
    for m in maps[1:]:
        out = out.join(m.select(F.col("u").alias("root"), "r"), "root", "left").select("node", F.coalesce("r", "root").alias("root"))
    return scratch.keep(out, f"{name}-roots")


# ---------------------------------------------------------------------------------------
# the matrix
# ---------------------------------------------------------------------------------------


def common_shingles(described: DataFrame, params: JoinParams) -> np.ndarray:
    """Bitmap of shingles that many documents have.  Only the order of prefixes depends on it; any
    set gives the same links."""
    rows = described.where(F.col("common").isNotNull()).groupBy("common").agg(F.sum("n").alias("documents"))
    return C.bitmap(rows.where(F.col("documents") >= params.common_documents), "common")


#: Low bits of a place in the order that are not told: a coarse place takes fewer bytes, and two equal
#: ones decide nothing.
COARSE = 44


def prefixes(docs: DataFrame, common: np.ndarray, params: JoinParams) -> DataFrame:
    """(token, node, last): the first shingles of each set, rare ones first, then by name; ``last``
    is the coarse place of the set's last one in that order, with the shingle's own position among the
    set's in its low bits.

    With inter >= 3/7 of the sizes' sum (for 75 %), a set must share one of its first
    n - ceil(p n) + 1 shingles with any linked set of at most its size, and that one is among the
    other's first n - ceil(2p/(1+p) n) + 1, which carry the flag in the node's lowest bit."""
    p = params.percent

    def run(batches):
        C.release()
        seen = C.Seen()
        for _, data, offsets in C.chunks(batches, "text"):
            tokens, nodes, lasts = [], [], []
            for s in shingle_sets(data, offsets, params.width):
                n = len(s)
                if not n:
                    continue
                node = node_of(s)
                if seen.again(node):
                    continue
                late = C.in_bitmap(common, s)
                probe, index = n + 1 - -(-p * n // 100), n + 1 - -(-2 * p * n // (100 + p))
                first = np.r_[s[~late], s[late]][:probe] if late.any() else s[:probe]
                flags = np.full(len(first), node, np.int64)
                flags[:index] |= 1
                tokens.append(first)
                nodes.append(flags)
                place = (int(first[-1] >> U64(2)) | int(len(first) > int((~late).sum())) << 62) >> COARSE << COARSE
                lasts.append(place + np.arange(len(first), dtype=np.int64))
            if tokens:
                yield pa.RecordBatch.from_pydict({
                    "token": pa.array(C.signed(np.concatenate(tokens))), "node": pa.array(np.concatenate(nodes)), "last": pa.array(np.concatenate(lasts))})

    return docs.select("text").mapInArrow(run, "token long, node long, last long")


def shared_only(rows: DataFrame) -> DataFrame:
    """Rows (token, node, last) whose token belongs to two sets or more, each once, with the position
    (``at``) told apart.  One shuffle; a task streams over its sorted tokens and holds at most one set's
    rows of a token."""
    columns = ["token", "node", "last"]

    def run(batches):
        held, many = None, False  # the last token's rows while they are of one set
        for batch in batches:
            t, n, last = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(t):
                continue
            if held is not None and t[0] == held[0][0]:
                if many:
                    t, n, last = np.r_[held[0][:1], t], np.r_[held[1][:1], n], np.r_[held[2][:1], last]
                else:
                    t, n, last = np.r_[held[0], t], np.r_[held[1], n], np.r_[held[2], last]
                known = 1 if many else 0
            else:
                known, many = 0, False
            once = np.r_[True, (t[1:] != t[:-1]) | (n[1:] != n[:-1])]  # several tasks may have met one set
            t, n, last = t[once], n[once], last[once]
            heads = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
            tails = np.r_[heads[1:], len(t)] - 1
            multi = n[heads] >> 1 != n[tails] >> 1
            if known:
                multi[0] = True  # its first rows were sent before
            keep = np.repeat(multi, tails - heads + 1)
            many = bool(multi[-1])
            held = (t[-1:], n[-1:], last[-1:]) if many else tuple(x[heads[-1]:] for x in (t, n, last))
            if not many:
                first = np.unique(held[1], return_index=True)[1]
                held = tuple(x[first] for x in held)
            keep[:known] = False
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (t, n, last)], columns)

    found = rows.repartition("token").sortWithinPartitions("token", "node").mapInArrow(run, "token long, node long, last long")
    return found.select("token", F.col("node").bitwiseAND(F.lit(~1)).alias("node"), (F.col("node").bitwiseAND(F.lit(1)) == 1).alias("index"),
                        F.col("last").bitwiseAND(F.lit(-1 << COARSE)).alias("last"), F.col("last").bitwiseAND(F.lit((1 << COARSE) - 1)).alias("at"))


def needed_overlap(a: Column, b: Column, percent: int) -> Column:
    """Least intersection of linked sets of these sizes."""
    return F.ceil((a + b) * percent / (100 + percent))


def may_be_first(params: JoinParams) -> Column:
    """Whether a shingle can be the first one that a query (its position there: ``qat``) has in common with
    a linked member of the group (first position in any member: ``at``).

    What precedes the first common shingle on either side is missing from the other, so the overlap is at
    most what follows on each side.  Every linked pair meets under its first common shingle; under others
    it need not be paired again."""
    p = params.percent
    least = F.greatest(F.col("low"), F.ceil(F.col("qn") * p / 100))
    most = F.least(F.col("high"), F.col("qn"))
    return ((F.col("qn") - F.col("qat") >= needed_overlap(F.col("qn"), least, p))
            & (most - F.col("at") >= needed_overlap(F.col("qn"), most, p)))


def qualified(pairs: DataFrame, rows: DataFrame, params: JoinParams) -> DataFrame:
    """Pairs (q, grp) whose overlap bound reaches what a link needs.

    Let c be the query's prefix shingles in the union of the group's prefixes.  If the query's prefix
    ends before every member's does, each of its other prefix shingles is missing from every member;
    if it ends after every member's, each member's other prefix shingles are missing from the query.
    Either way what is missing bounds the overlap from above."""
    p = params.percent
    probe = lambda n: n + 1 - F.ceil(n * p / 100)
    needed = lambda a, b: needed_overlap(a, b, p)
    union = rows.select("token", "grp").distinct()
    common = (pairs.join(rows.select(F.col("node").alias("q"), "token"), "q").join(union, ["token", "grp"])
              .groupBy("q", "grp").agg(F.count("*").alias("c")))
    asked = rows.select(F.col("node").alias("q"), F.col("n").alias("qn"), F.col("last").alias("qlast")).distinct()
    groups = rows.groupBy("grp").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.min("last").alias("soonest"), F.max("last").alias("latest"))
    least = F.greatest(F.col("low"), F.ceil(F.col("qn") * p / 100))
    most = F.least(F.col("high"), F.col("qn"))
    enough = (F.when(F.col("qlast") < F.col("soonest"), F.col("c") >= needed(F.col("qn"), least) - F.col("qn") + probe(F.col("qn")))
              .when(F.col("qlast") > F.col("latest"), F.col("c") >= needed(F.col("qn"), most) - most + probe(most) - 1)
              .otherwise(F.lit(True)))
    return common.join(asked, "q").join(groups, "grp").where(enough).select("q", "grp")


#: A crowded key is cut in four as often as it takes to come below ``block`` members.
CUT = 4


def _subs(keys: np.ndarray, nodes: np.ndarray, crowded: list[np.ndarray]) -> np.ndarray:
    """The block of a key that a node belongs to: ``crowded[i]`` marks the keys that are cut i + 1 times.  A
    key marked by chance is cut once more than it needs, on every executor alike."""
    parts = np.ones(len(keys), U64)
    for marks in crowded:
        parts[C.in_bitmap(marks, keys.view(U64))] *= U64(CUT)
    return C.signed(C.mix(nodes.view(U64)) % parts)


def first_links(docs: DataFrame, described: DataFrame, scratch: C.Scratch, params: JoinParams) -> tuple[DataFrame, DataFrame]:
    """(links inside the first groups, (node, key, sub) of the documents in them).

    Sets are sent straight to their group: which keys have company, and which are crowded, is known from
    bitmaps, so no set travels to be looked up first."""
    names = [f"k{j}" for j in range(params.orders)]
    nodes = described.where("n > 0").select("node", *names).distinct()
    keyed = scratch.keep(nodes.select("node", F.explode(F.array(*names)).alias("key")).distinct(), "keyed")
    groups = scratch.keep(keyed.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "groups")
    company = C.bitmap(groups, "key")
    crowded, most = [], params.block
    # what falls apart here meets again in the matrix
    while not (rows := groups.where(F.col("m") > most)).isEmpty():
        crowded.append(C.bitmap(rows, "key"))
        most *= CUT
    percent, width, orders = params.percent, params.width, params.orders

    def place(batches):
        for batch in batches:
            node, key = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            hit = C.in_bitmap(company, key.view(U64))
            yield pa.RecordBatch.from_pydict({"node": pa.array(node[hit]), "key": pa.array(key[hit]), "sub": pa.array(_subs(key[hit], node[hit], crowded))})

    places = scratch.keep(keyed.mapInArrow(place, "node long, key long, sub long"), "places")
    scratch.drop("keyed", "groups")

    def send(batches):
        C.release()
        seen = C.Seen()
        for _, data, offsets in C.chunks(batches, "text"):
            sets = [s for s in shingle_sets(data, offsets, width) if len(s)]
            own = [(node, s) for node, s in ((node_of(s), s) for s in sets) if not seen.again(node)]
            pairs = [(k, node, s) for node, s in own for k in dict.fromkeys(_keys(s, orders))]
            key, node = np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)
            hit = C.in_bitmap(company, key.view(U64)) if len(pairs) else np.zeros(0, bool)
            yield pa.RecordBatch.from_pydict({
                "key": pa.array(key[hit]), "sub": pa.array(_subs(key[hit], node[hit], crowded)), "node": pa.array(node[hit]),
                "tokens": pa.array([pairs[i][2].tobytes() for i in np.flatnonzero(hit).tolist()], pa.binary())})

    sets = docs.select("text").mapInArrow(send, "key long, sub long, node long, tokens binary")
    found = sets.groupBy("key", "sub").applyInArrow(_links_inside(percent), "u long, v long")
    return scratch.keep(found, "first-links"), places


def opened(docs: DataFrame, grouped: DataFrame, pairs: DataFrame, name: str, scratch: C.Scratch, params: JoinParams) -> DataFrame:
    """Links between the queries and the members of the groups of ``pairs`` (q, grp), at least one of a query
    to each component that it has a link to."""
    load = pairs.groupBy("grp").agg(F.ceil(F.count("*") / params.queries).alias("parts"))
    members = scratch.keep(grouped.join(load, "grp").select("node", "comp", "grp", "parts"), f"{name}-members")
    wanted = members.select("node").union(pairs.select(F.col("q").alias("node"))).distinct()
    sets = scratch.keep(sets_of(docs, wanted, params), f"{name}-sets")
    side = (sets.join(members, "node").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
            .select(F.col("grp").alias("member_grp"), F.col("part").alias("member_part"), F.col("node").alias("member"),
                    F.col("comp").alias("member_comp"), F.col("tokens").alias("member_tokens")))
    asking = (pairs.withColumnRenamed("q", "node").join(load, "grp").withColumn("part", F.pmod(F.xxhash64("node", F.lit(5)), F.col("parts")))
              .join(sets, "node").select("grp", "part", "node", "tokens"))
    found = (side.groupBy("member_grp", "member_part").cogroup(asking.groupBy("grp", "part"))
             .applyInArrow(_open_group(params.percent), "u long, v long"))
    found = scratch.keep(found, name)
    scratch.drop(f"{name}-members", f"{name}-sets")
    return found


def crowded_tops(rows: DataFrame, turn: int, params: JoinParams) -> DataFrame:
    """(token, top, grp, pairs): for each crowded shingle the component with most rows under it, one of its
    groups there (another one each turn), and rows times further components that can be asked."""
    place = F.struct((~F.col("index")).alias("late"), F.xxhash64("grp", F.lit(turn)).alias("order"), "grp")
    own = rows.groupBy("token", "comp").agg(F.max("index").alias("index"), F.count("*").alias("m"), F.min(place).alias("one"))
    tops = own.groupBy("token").agg(F.max(F.struct("index", "m", "comp", F.col("one.grp").alias("grp"))).alias("top"), F.sum("m").alias("m"),
                                    F.sum(F.col("index").cast("long")).alias("comps"))
    tops = tops.withColumn("pairs", F.col("m") * (F.col("comps") - 1)).where(F.col("pairs") > params.crowded_pairs)
    return tops.select("token", F.col("top.comp").alias("top"), F.col("top.grp").alias("grp"), "pairs")


def early_links(docs: DataFrame, rows: DataFrame, grouped: DataFrame, scratch: C.Scratch, params: JoinParams) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """(``rows`` and ``grouped`` with larger components, links behind these).

    Of many documents alike, most are one component by now, and all of them would ask every group that
    fell out of it.  So where crowded shingles would pair more than there are rows, what is left under one
    first asks one group of the component with most rows there: one pair a row at most.  Connected components do not ask each other any more; what
    stays apart is compared in full later."""
    links = []
    for turn in range(params.early):
        tops = scratch.keep(crowded_tops(rows, turn, params), f"tops{turn}")
        if (tops.agg(F.sum("pairs")).first()[0] or 0) <= rows.count():  # no more than grows with the input
            break
        pairs = (rows.select("token", F.col("node").alias("q"), F.col("comp").alias("qc"), F.col("grp").alias("qg")).join(tops, "token")
                 .where((F.col("qc") != F.col("top")) & (F.col("qg") != F.col("grp"))).select("q", "grp").distinct())
        pairs = qualified(scratch.keep(pairs, f"early-asked{turn}"), rows, params)
        found = opened(docs, grouped, scratch.keep(pairs, f"early-pairs{turn}"), f"early-links{turn}", scratch, params)
        comp = lambda c: grouped.select(F.col("node").alias(c), F.col("comp").alias(f"{c}c"))
        edges = found.join(comp("u"), "u").join(comp("v"), "v").select(F.col("uc").alias("u"), F.col("vc").alias("v"))
        larger = components(edges, scratch, f"early{turn}").select(F.col("node").alias("comp"), "root")
        if larger.isEmpty():
            break
        links.append(found)
        renamed = lambda df: df.join(larger, "comp", "left").withColumn("comp", F.coalesce("root", "comp")).select(*df.columns)  # noqa: E731, B023
        rows, grouped = scratch.keep(renamed(rows), f"rows{turn}"), scratch.keep(renamed(grouped), f"grouped{turn}")
        scratch.drop("rows" if not turn else f"rows{turn - 1}")
    return rows, grouped, links


def cross_links(docs: DataFrame, table: DataFrame, roots: DataFrame, places: DataFrame, scratch: C.Scratch, params: JoinParams) -> DataFrame:
    """Links between documents of different components, through the token-group matrix."""
    sizes = roots.groupBy("root").agg(F.count("*").alias("members"))
    own = places.groupBy("node").agg(F.min(F.struct("key", "sub")).alias("own"))
    nodes = table.where("node is not null").select("node", "n").distinct()
    # groups: blocks of a component, else the first group, else the document alone
    grouped = (nodes.join(roots, "node", "left").join(sizes, "root", "left").join(own, "node", "left")
               .select("node", "n", F.coalesce("root", "node").alias("comp"),
                       F.when(F.col("root").isNotNull(), F.xxhash64(F.lit("c"), F.col("root"), F.pmod(F.xxhash64("node"), F.ceil(F.col("members") / params.block))))
                       .when(F.col("own").isNotNull(), F.xxhash64(F.lit("k"), F.col("own.key"), F.col("own.sub")))
                       .otherwise(F.xxhash64(F.lit("n"), F.col("node"))).alias("grp")))
    grouped = scratch.keep(grouped, "grouped")
    common = common_shingles(table, params)
    for attempt in range(params.redo + 1):
        shared = shared_only(prefixes(docs, common, params)).join(grouped, "node")
        shared = scratch.keep(shared, f"shared{attempt}")
        crossing = shared.groupBy("token").agg(F.min("comp").alias("a"), F.max("comp").alias("b"), F.approx_count_distinct("grp").alias("groups")).where("a <> b")
        crossing = scratch.keep(crossing.select("token", "groups"), f"crossing{attempt}")
        crowded = crossing.where(F.col("groups") > params.crowded_groups)
        # prefixes are read anew only where crowded shingles would pair more groups than there are rows
        pairs = crowded.agg(F.sum(F.col("groups") * F.col("groups"))).first()[0] or 0
        if attempt == params.redo or pairs <= shared.count():
            break
        more = C.bitmap(crowded, "token", 8 * len(common)) & ~common
        if not more.any():
            break
        common = common | more
        scratch.drop(f"shared{attempt}", f"crossing{attempt}")
    # written once more: most rows belong to tokens of one component only and travel no further
    rows = scratch.keep(shared.join(crossing.select("token"), "token", "left_semi"), "rows")
    scratch.drop(f"shared{attempt}", f"crossing{attempt}")
    rows, grouped, links = early_links(docs, rows, grouped, scratch, params)
    matrix = (rows.where("index").groupBy("token", "grp").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.min("at").alias("at")))
    asked = rows.select("token", F.col("node").alias("q"), F.col("n").alias("qn"), F.col("at").alias("qat"), F.col("comp").alias("qc"), F.col("grp").alias("qg"))
    pairs = (asked.join(matrix, "token")
             .where((F.col("low") <= F.col("qn")) & (100 * F.col("high") >= params.percent * F.col("qn")) & (F.col("grp") != F.col("qg"))
                    & ((F.col("c0") != F.col("qc")) | (F.col("c1") != F.col("qc"))) & may_be_first(params))
             .select("q", "grp").distinct())
    pairs = scratch.keep(pairs, "pairs")
    pairs = scratch.keep(qualified(pairs, rows, params), "qualified")
    found = opened(docs, grouped, pairs, "cross-links", scratch, params)
    for one in links:
        found = found.union(one)
    return found


def membership(docs: DataFrame, params: JoinParams = JoinParams()) -> DataFrame:
    """doc_id, n, node, root of every document of ``docs`` (doc_id, text); linked documents, in
    one step or many, have equal roots (NULL for the empty set)."""
    docs = docs.select("doc_id", "text")
    scratch = C.Scratch(docs.sparkSession, "jaccard")
    table = scratch.keep(describe(docs, params), "described")
    described = table.where(F.col("common").isNull())
    inside, places = first_links(docs, described, scratch, params)
    roots = components(inside, scratch, "first")
    across = cross_links(docs, table, roots, places, scratch, params)
    roots = components(inside.union(across), scratch, "all")
    for name in list(scratch.live):
        if name not in ("described", "all-roots") and not name.startswith("all-edges"):
            scratch.drop(name)
    return described.select("doc_id", "n", "node").join(roots, "node", "left").select("doc_id", "n", "node", F.coalesce("root", "node").alias("root"))


def similar_components(docs: DataFrame, params: JoinParams = JoinParams()) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id that links reach) of every document."""
    rows = membership(docs, params)
    smallest = rows.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("component"))
    return rows.join(smallest, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"))


def one_of_each(docs: DataFrame, params: JoinParams = JoinParams()) -> DataFrame:
    """``docs`` with one document of each component: the smallest doc_id (NULL last).  Documents
    without words all stay, and of rows alike in doc_id and shingles one stays."""
    rows = membership(docs, params)
    best = Window.partitionBy("root").orderBy(F.col("doc_id").asc_nulls_last(), "node")
    first = (rows.where(F.col("root").isNotNull()).withColumn("place", F.row_number().over(best)).where("place = 1")
             .select(F.col("doc_id").cast("string").alias("_jaccard_kept_id"), F.col("node").alias("_jaccard_kept_node")))
    scratch = C.Scratch(docs.sparkSession, "representatives")
    first = scratch.keep(first, "first")

    def key(doc_id, node) -> int:
        return C.digest(f"{doc_id}:{node}".encode())[0]

    def keys(batches):
        for batch in batches:
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            yield pa.RecordBatch.from_pydict({"key": pa.array([key(*p) for p in pairs], pa.int64())})

    marks = C.bitmap(first.mapInArrow(keys, "key long"), "key")
    names = docs.columns
    id_at = names.index("doc_id")

    def name(batches):
        # a clear bit proves that a row is not kept: copies are dropped before any shuffle
        for part, data, offsets in C.chunks(batches, "text"):
            nodes = [node_of(s) if len(s) else None for s in shingle_sets(data, offsets, params.width)]
            own = np.array([key(i, n) for i, n in zip(part.column(id_at).to_pylist(), nodes)], np.int64)
            stay = C.in_bitmap(marks, own.view(U64)) | np.array([n is None for n in nodes]) if len(own) else np.zeros(0, bool)
            named = pa.RecordBatch.from_arrays([*part.columns, pa.array(nodes, pa.int64())], [*names, "_jaccard_node"])
            yield named.filter(pa.array(stay))

    named = docs.mapInArrow(name, T.StructType([*docs.schema.fields, T.StructField("_jaccard_node", T.LongType())]))
    found = (named.where(F.col("_jaccard_node").isNotNull()).join(first, F.col("_jaccard_node") == F.col("_jaccard_kept_node"))
             .where(F.col("doc_id").cast("string").eqNullSafe(F.col("_jaccard_kept_id"))))
    alike = Window.partitionBy("_jaccard_node").orderBy(F.xxhash64("text"))
    found = found.withColumn("_jaccard_place", F.row_number().over(alike)).where("_jaccard_place = 1")
    return found.select(*names).unionByName(named.where(F.col("_jaccard_node").isNull()).select(*names))
