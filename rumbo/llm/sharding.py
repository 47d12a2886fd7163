"""Sharding by balanced label propagation under capacity quotas.

Law ``rows``: shard counts differ by one at most.  Rows of equal text are linked
with each other.  A row's label is its current shard, at first a hashed one;
rows of a text with the same label are equivalent, so the labels are kept as a table
``(text, shard, rows)``.  In each round (:func:`propagate`) the table is joined with its texts' links: every
row that is not on the shard where most of its neighbours are now asks to move there (or to the next-commonest one,
if that has no room for its text); a shard admits moves as far as its quota goes, in a hashed order; the moves admitted make the next
table.  A round is kept only if no more links are cut than before; the rounds end when none is cut, none is
admitted or the cut no longer falls.  What is left is finished by whole groups (:func:`finish`): a group still on several shards
asks for the commonest of them that has room for all of it, or, when none has, for
another one drawn in proportion to the room, until no group is left that any
shard has room for.  Groups of more than a
64th of a shard are few (about 64 a shard) and are settled one by one before
the rounds, the largest first, so that small groups do not take the room they need.  A group that no shard has room for, such as one
larger than a shard, fills the roomiest shard and goes on as a group of its
other rows, so it lies on as few shards as the room allows.  Rows without links
are filler: they are dealt into the gaps last, so the counts come out exact
whatever the linked rows did.

All numbering (admission order, gaps, slots) is two-level: rows are counted in
hashed sub-buckets, the few counts are summed, and only sub-buckets are sorted.

Defined cases: null text has no bytes and equals the empty text; repeated rows
are rows of their own and linked to each other; a very long text is hashed where it is read; an empty table gives no rows;
extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import store

ROWS_PER_BUCKET = 4000
LARGE = 64                     # a group of more than a LARGE-th of a shard is settled alone


def numbered(df: DataFrame, key: str, row: str, rows: int, name: str, salt: int, size: str | None = None) -> DataFrame:
    """Gapless number from 0 within ``key``, in a hashed order of ``row``; ``rows`` sets the sub-buckets.

    With ``size`` it is the sum of the sizes before the row.
    """
    buckets = max(1, -(-rows // ROWS_PER_BUCKET))
    df = df.withColumn("__b", F.pmod(F.xxhash64(row, F.lit(salt)), F.lit(buckets)))
    counts = df.groupBy(key, "__b").agg((F.sum(size) if size else F.count("*")).alias("count"))
    before = Window.partitionBy(key).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col(key).alias("__k"), F.col("__b").alias("__b2"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__s"))
    line = Window.partitionBy(key, "__b").orderBy(row)
    inside = F.sum(size).over(line.rowsBetween(Window.unboundedPreceding, 0)) - F.col(size) if size else F.row_number().over(line) - 1
    return df.withColumn("__i", inside).join(starts, (F.col(key) == F.col("__k")) & (F.col("__b") == F.col("__b2"))).withColumn(
        name, F.col("__s") + F.col("__i")).drop("__b", "__k", "__b2", "__s", "__i")


def groups_of(rows: DataFrame, row: str, group: str, shards: int, seed: int = 3) -> DataFrame:
    """``(g, n, labels)`` of every group of two or more rows; ``labels``: rows and shard of its starting labels, the commonest (of equals the smaller) first."""
    label = F.pmod(F.xxhash64(row, F.lit(seed)), F.lit(shards)).cast("int")
    counts = rows.groupBy(F.col(group).alias("g"), label.alias("shard")).agg(F.count("*").alias("n"))
    # at most ``shards`` labels in a list
    return counts.groupBy("g").agg(F.sum("n").alias("n"), _labels("n", "shard").alias("labels")).filter(F.col("n") > 1)


def _labels(n: str, shard: str) -> Column:
    return F.sort_array(F.collect_list(F.struct((-F.col(n)).alias("less"), F.col(shard).alias("shard"))))


def cut_links(labels: DataFrame) -> int:
    """Links that a label table cuts: rows that are not on the commonest shard of their text."""
    per = labels.groupBy("g").agg((F.sum("n") - F.max("n")).alias("off"))
    return int(per.agg(F.sum("off")).first()[0] or 0)


def propagate(labels: DataFrame, room: list[int], seed: int = 3) -> tuple[DataFrame, list[int]]:
    """The label table ``(g, shard, n)`` after the rounds, and the links cut before them and after each.

    ``room``: rows that each shard may hold.
    """
    cuts = [cut_links(labels)]
    while cuts[-1]:
        # at most one load for each shard
        load = {r["shard"]: r["n"] for r in labels.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
        free = F.array(*[F.lit(max(0, r - load.get(s, 0))) for s, r in enumerate(room)])
        draw = F.xxhash64("g", "shard", F.lit(seed))          # of equally common shards none is favoured by all texts
        order = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("less"), draw.alias("draw"), F.col("shard").alias("shard"))))
        heard = labels.groupBy("g").agg(F.sum("n").alias("all"), order.alias("labels"))
        room_for = F.filter("labels", lambda x: F.get(free, x["shard"]) >= F.col("all") + x["less"])
        most = heard.select("g", F.get(room_for, F.lit(0))["shard"].alias("to")).filter(F.col("to").isNotNull())
        wishes = labels.join(most, "g").filter(F.col("shard") != F.col("to")).withColumn("unit", F.xxhash64("g", "shard"))
        count = wishes.count()
        if not count:
            break
        lined = store(numbered(wishes, "to", "unit", count, "before", seed + len(cuts), "n"), "shard-moves")
        admitted = lined.filter(F.col("before") + F.col("n") <= F.get(free, F.col("to")))
        gone = admitted.select(F.col("g").alias("g2"), F.col("shard").alias("shard2"))
        stay = labels.join(gone, (F.col("g") == F.col("g2")) & (F.col("shard") == F.col("shard2")), "left_anti")
        moved = admitted.select("g", F.col("to").alias("shard"), "n")
        after = store(stay.select("g", "shard", "n").unionByName(moved).groupBy("g", "shard").agg(F.sum("n").alias("n")), "shard-labels")
        cut = cut_links(after)
        if cut > cuts[-1]:
            break
        cuts.append(cut)
        labels = after
        if cuts[-1] == cuts[-2]:
            break
    return labels, cuts


def settle(groups: list[tuple[bytes, int, list[int]]], room: list[int], tight: bool = False) -> dict[bytes, list[tuple[int, int]]]:
    """``(shard, rows)`` pieces of each group, the largest group first; ``room`` is used up.

    A group goes to the commonest of its shards with room for it, or else to the
    roomiest shard; ``tight``: to the shard with the least room that is enough.
    When no shard has room for it, it fills the roomiest one and its other rows
    wait for their turn as a smaller group.
    """
    rank = {g: {s: i for i, s in enumerate(votes)} for g, _, votes in groups}
    out: dict[bytes, list[tuple[int, int]]] = {}
    line = [(-n, g) for g, n, _ in groups]
    heapify(line)
    while line:
        n, g = heappop(line)
        n = -n
        voted = lambda s: (rank[g].get(s, len(room)), -room[s], s)  # noqa: B023, E731
        open_ = [s for s in range(len(room)) if room[s] >= n]
        if open_:
            shard = min(open_, key=lambda s: (room[s] if tight else 0, *voted(s)))
        else:
            shard = min(range(len(room)), key=lambda s: (-room[s], *voted(s)))
            heappush(line, (room[shard] - n, g))
        n = min(n, room[shard])
        room[shard] -= n
        out.setdefault(g, []).append((shard, n))
    return out


def _settled(labels: DataFrame, room: list[int], seed: int) -> tuple[DataFrame, DataFrame]:
    """Groups on one shard that its room holds, ``(g, shard)``, and the others ``(g, n, votes)``; ``room`` is used up by the former."""
    per = labels.groupBy("g").agg(F.sum("n").alias("n"), _labels("n", "shard").alias("labels"))
    per = store(per.withColumn("shard", F.col("labels")[0]["shard"]), "shard-whole")
    whole = numbered(per.filter(F.size("labels") == 1), "shard", "g", per.count(), "before", seed, "n")
    rooms = F.array(*[F.lit(r) for r in room])
    fits = store(whole.withColumn("fits", F.col("before") + F.col("n") <= F.get(rooms, F.col("shard"))), "shard-fits")
    kept = fits.filter("fits")
    for r in kept.groupBy("shard").agg(F.sum("n").alias("n")).collect():
        room[r["shard"]] -= r["n"]
    votes = F.col("labels")["shard"].alias("votes")
    left = per.filter(F.size("labels") > 1).select("g", "n", votes).unionByName(fits.filter("NOT fits").select("g", "n", votes))
    return kept.select("g", "shard"), left


def place_groups(groups: DataFrame, room: list[int], seed: int = 3) -> tuple[dict[bytes, list[tuple[int, int]]], DataFrame | None, list[int]]:
    """Shards of the groups ``(g, n, labels)``: pieces of the large and the cut ones, a frame ``(g, shard)`` of the
    others, and the cuts of the rounds; ``room`` is used up."""
    limit = sum(room) // len(room) // LARGE
    large = _votes(groups.filter(F.col("n") > limit).select("g", "n", F.col("labels")["shard"].alias("votes")))
    start = list(room)
    alone = settle(large, room)
    if any(len(alone[g]) > 1 and n <= max(start) for g, n, _ in large):
        # the votes left gaps that are too small: best fit, if it cuts less
        other = list(start)
        closer = settle(large, other, tight=True)
        if sum(map(len, closer.values())) < sum(map(len, alone.values())):
            alone, room[:] = closer, other
    small = groups.filter(F.col("n") <= limit).select("g", F.explode("labels").alias("l")).select(
        "g", F.col("l.shard").alias("shard"), (-F.col("l.less")).alias("n"))
    labels, cuts = propagate(store(small, "shard-labels"), room, seed)
    whole, left = _settled(labels, room, seed)
    alone_more, moved = finish(left, room, seed)
    alone.update(alone_more)
    return alone, whole if moved is None else whole.unionByName(moved), cuts


def _votes(df: DataFrame) -> list[tuple[bytes, int, list[int]]]:
    return [(bytes(r["g"]), r["n"], r["votes"]) for r in df.collect()]


def finish(left: DataFrame, room: list[int], seed: int = 3) -> tuple[dict[bytes, list[tuple[int, int]]], DataFrame | None]:
    """Place whole groups ``(g, n, votes)`` until none is left that a shard has room for; the rest is settled in pieces."""
    shards, alone, moved, k = len(room), {}, None, 0
    while True:
        most = max(room)
        # fewer groups than shards: together the groups left have at most the room of all shards
        alone.update(settle(_votes(left.filter(F.col("n") > most)), room))
        left = left.filter(F.col("n") <= most)
        if max(room) < most:
            continue
        size = left.count()
        if not size:
            return alone, moved
        rooms = F.array(*[F.lit(r) for r in room])
        ends = [sum(room[:s + 1]) for s in range(shards)]
        fits = lambda s: F.get(rooms, s) >= F.col("n")
        draw = F.xxhash64("g", F.lit(seed + k))
        drawn = _interval(F.pmod(draw, F.lit(ends[-1])), ends)
        open_ = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), fits)
        wish = F.coalesce(F.get(F.filter("votes", fits), F.lit(0)), F.when(fits(drawn), drawn),
                          F.get(open_, F.pmod(draw, F.size(open_)).cast("int")))
        lined = store(numbered(left.withColumn("wish", wish), "wish", "g", size, "before", seed + k, "n"), "shard-round")
        admitted = F.col("before") + F.col("n") <= F.get(rooms, F.col("wish"))
        now = lined.filter(admitted)
        for r in now.groupBy("wish").agg(F.sum("n").alias("n")).collect():
            room[r["wish"]] -= r["n"]
        now = now.select("g", F.col("wish").alias("shard"))
        moved = now if moved is None else moved.unionByName(now)
        left = lined.filter(~admitted).select("g", "n", "votes")
        k += 1


def shard_documents(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, size, text_crc32, law, shard, slot, grown_shard)`` for every row; equal texts are linked."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = store(docs.select(F.col(f"`{id_col}`").alias("id"), (F.octet_length(text) + 16).cast("long").alias("size"),
                             F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text.cast("binary"))).alias("g"),
                             F.monotonically_increasing_id().alias("row")), "shard-rows")
    n = rows.count()
    room = [n // shards + (s < n % shards) for s in range(shards)]
    alone, moved, _ = place_groups(store(groups_of(rows, "row", "g", shards), "shard-groups"), room)
    # the rows of large and cut groups stay where they are read: a few groups, broadcast
    whole = [(g, p[0][0]) for g, p in alone.items() if len(p) == 1]
    cut = [(g, [s for s, _ in p], [sum(c for _, c in p[:i + 1]) for i in range(len(p))]) for g, p in alone.items() if len(p) > 1]
    kept = rows.join(F.broadcast(spark.createDataFrame(whole, "g binary, shard int")), "g")
    if cut:
        pieces = F.broadcast(spark.createDataFrame(cut, "g binary, piece array<int>, upto array<long>"))
        dealt = numbered(rows.join(pieces.select("g"), "g", "left_semi"), "g", "row", n, "place", 1).join(pieces, "g")
        at = F.size(F.filter("upto", lambda x: x <= F.col("place")))
        kept = kept.unionByName(dealt.withColumn("shard", F.get("piece", at)).drop("place", "piece", "upto"))
    large = F.broadcast(spark.createDataFrame([(g,) for g in alone], "g binary"))
    others = rows.join(large, "g", "left_anti")
    others = others.join(moved, "g", "left")
    labels = store(kept.unionByName(others).drop("g"), "shard-labels")
    loose = labels.filter(F.col("shard").isNull()).withColumn("all", F.lit(0))
    filled = numbered(loose, "all", "row", n, "place", 2)
    # at most ``shards`` intervals: one literal array, looked up without a join
    bounds = [sum(room[:s + 1]) for s in range(shards)]
    filler = filled.withColumn("shard", _interval(F.col("place"), bounds)).drop("all", "place")
    placed = labels.filter(F.col("shard").isNotNull()).unionByName(filler)
    out = numbered(store(placed, "shard-placed"), "shard", "row", n, "slot", 4)
    return out.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
                      F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def _interval(place: Column, bounds: list[int]) -> Column:
    """Number of bounds that are not above ``place``."""
    return F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= place)).cast("int")
