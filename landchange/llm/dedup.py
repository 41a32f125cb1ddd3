"""New batches against all that was accepted before, without reading the history again.

The history is two bucketed tables of what was accepted: hashes of exact keys, of ids and of whole outlines, and hashes of the
parts an outline covers (grid cells at a level that follows its size, as paragraphs are for a text). A batch's rows look their
exact hashes up in the first and their parts in the second (bucket-local joins: only the batch moves); what two outlines share
of the parts they both cover bounds their common area, and where that bound is large enough the outlines are compared exactly.
Rows that repeat nothing are accepted and their hashes are appended.

Inside a batch only outlines that differ are compared, and of a crowded cell only the first few that are still open: what these
repeat is settled, the accepted ones are looked up by the rest, and so on. Equal rows, however many, never meet in pairs.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from landchange.operators.overlap import all_edges, areas, bounding_edges, common_areas, outline_edges  # noqa: F401
from landchange.session import shared_dir, shuffle_parts, stage

SAME_AREA = 0.7
#: Open outlines of a cell that are compared in one round; open rows that one task settles.
FIRST_OF_CELL, LOCAL_ROWS = 64, 200_000
CELLS_DDL = "ARRAY<STRUCT<cell:BIGINT,level:INT,cx:BIGINT,cy:BIGINT,own:BOOLEAN>>"
OUTLINE_DDL = "cls STRING, year INT, area DOUBLE, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE"
BOX = ["area", "x0", "y0", "x1", "y1"]


def plain_id(value: Column) -> Column:
    """An id in letters and digits, without case, braces, dashes and urn:uuid:; null where nothing is left."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(value), r"^\s*urn:uuid:", ""), r"[^\p{L}\p{N}]", "")
    return F.when(bare != "", bare)


def levels_of(area: np.ndarray, least: float = SAME_AREA) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of level k are 2^k wide. An outline's own level is the least at which a cell is twice the root of its area, so no
    cell lies inside it whole; also the lowest and highest level that an outline alike enough may have."""
    level = lambda a: np.ceil(np.log2(2 * np.sqrt(a))).astype(np.int64)
    return level(area), level(area * least * 0.999999), level(area / (least * 0.999999))


def cells_met(edges: np.ndarray, owner: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (owner, cx, cy) of cells, 2^level wide by owner, that an edge runs through: as no cell lies inside an outline,
    these are all that hold a part of it. Their number follows the outline's length, not its box."""
    side = np.exp2(level[owner].astype(float))
    low, high = np.minimum(edges[:, 1], edges[:, 3]), np.maximum(edges[:, 1], edges[:, 3])
    first = np.floor(edges[:, 0] / side).astype(np.int64)
    across = np.floor(edges[:, 2] / side).astype(np.int64) - first + 1
    e = np.repeat(np.arange(len(edges)), across)
    cx = first[e] + np.arange(len(e)) - np.repeat(np.cumsum(across) - across, across)
    x0, y0, x1, y1 = edges[e].T
    s, run = side[e], np.where(x1 > x0, x1 - x0, 1.0)
    at = lambda x: y0 + (y1 - y0) * np.clip((x - x0) / run, 0, 1)
    ya, yb = np.where(x1 > x0, at(cx * s), low[e]), np.where(x1 > x0, at((cx + 1) * s), high[e])
    slack = 1e-9 * s
    bottom, top = np.floor((np.minimum(ya, yb) - slack) / s).astype(np.int64), np.floor((np.maximum(ya, yb) + slack) / s).astype(np.int64)
    up = top - bottom + 1
    c = np.repeat(np.arange(len(cx)), up)
    cy = bottom[c] + np.arange(len(c)) - np.repeat(np.cumsum(up) - up, up)
    found = np.unique(np.column_stack([owner[e][c], cx[c], cy]), axis=0)
    return found[:, 0], found[:, 1], found[:, 2]


def cell_hash(*parts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of whole numbers."""
    h = np.full(len(parts[0]), 0x9E3779B97F4A7C15, np.uint64)
    for p in parts:
        h = (h ^ p.astype(np.int64).view(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def read_reviews(reviews: DataFrame, least: float = SAME_AREA) -> DataFrame:
    """rev_key, batch, id_key, the outline's cls, year, area and box, its edges and the cells it is looked up in (own: those
    under which it is kept). cls names an outline in its year; it is null, with the rest of the outline, where there is no
    year or no outline with an area. Rows without rev_key or batch are left out."""
    source = reviews.where("rev_key IS NOT NULL AND batch IS NOT NULL").select("rev_key", F.col("batch").cast("int"), plain_id(F.col("reviewId")).alias("id_key"), F.col("year").cast("int"), "geometry")

    def lists(values: pa.Array, sizes: np.ndarray, there: np.ndarray) -> pa.Array:
        ends = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32), pa.int32(), mask=np.append(~there, False))
        return pa.ListArray.from_arrays(ends, values)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            names: list[str | None] = [None] * n
            area, box = np.full(n, np.nan), np.full((n, 4), np.nan)
            every, bounding = [np.zeros((0, 4))] * n, [np.zeros((0, 4))] * n
            for i, (year, text) in enumerate(zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())):
                if year is None or not len(e := all_edges(text)):
                    continue
                own = bounding_edges(e)
                if (size := areas(own, own[:0])[0]) > 0:
                    names[i], area[i], every[i], bounding[i] = hashlib.md5(f"{year}:".encode() + own.tobytes()).hexdigest(), size, e, own
                    box[i] = e[:, 0].min(), e[:, [1, 3]].min(), e[:, 2].max(), e[:, [1, 3]].max()
            there = ~np.isnan(area)
            has = np.flatnonzero(there)
            years = np.array(pa.compute.fill_null(batch.column(3), 0))
            own, low, high = levels_of(area[has], least)
            owner, cx, cy, level, kept = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
            for step in range(int((high - low).max()) + 1 if len(has) else 0):
                use = np.flatnonzero(low + step <= high)
                at = low[use] + step
                sizes = np.array([len(every[i]) for i in has[use]])
                o, x, y = cells_met(np.vstack([every[i] for i in has[use]]), np.repeat(np.arange(len(use)), sizes), at)
                owner, cx, cy = [*owner, has[use[o]]], [*cx, x], [*cy, y]
                level, kept = [*level, at[o]], [*kept, own[use[o]] == at[o]]
            owner, cx, cy, level, kept = map(np.concatenate, (owner, cx, cy, level, kept))
            order = np.argsort(owner, kind="stable")
            owner, cx, cy, level, kept = owner[order], cx[order], cy[order], level[order], kept[order]
            cells = pa.StructArray.from_arrays([pa.array(cell_hash(years[owner], level, cx, cy)), pa.array(level.astype(np.int32)), pa.array(cx), pa.array(cy), pa.array(kept)], ["cell", "level", "cx", "cy", "own"])
            flat = np.concatenate([np.zeros(0), *(b.ravel() for b in bounding)])
            columns = [batch.column(0), batch.column(1), batch.column(2), pa.array(names, pa.string()), batch.column(3), *(pa.array(v, mask=~there) for v in (area, *box.T))]
            columns += [lists(pa.array(flat), np.array([b.size for b in bounding], np.int64), there), lists(cells, np.bincount(owner, minlength=n), there)]
            yield pa.RecordBatch.from_arrays(columns, names=["rev_key", "batch", "id_key", "cls", "year", *BOX, "edges", "cells"])

    return source.mapInArrow(read, f"rev_key BIGINT, batch INT, id_key STRING, {OUTLINE_DDL}, edges ARRAY<DOUBLE>, cells {CELLS_DDL}")


def _same(a: str, b: str) -> Column:
    """Equal texts, in a form that doesn't become a join key: as a further key it would make a bucketed side move."""
    return (F.instr(F.col(a), F.col(b)) == 1) & (F.instr(F.col(b), F.col(a)) == 1)


def _covering(asking: DataFrame, held: DataFrame, first: str, least: float) -> DataFrame:
    """(a, b, at, first) of outlines whose shared cells, of which `at` is one, may hold enough common area: the sum, over the
    cells that both cover, of what their boxes have in common there is at least what the common area must be."""
    p, q = asking.alias("p"), held.alias("q")
    side = F.pow(F.lit(2.0), F.col("p.level"))
    width = F.least("p.x1", "q.x1", (F.col("p.cx") + 1) * side) - F.greatest("p.x0", "q.x0", F.col("p.cx") * side)
    height = F.least("p.y1", "q.y1", (F.col("p.cy") + 1) * side) - F.greatest("p.y0", "q.y0", F.col("p.cy") * side)
    alike = F.least("p.area", "q.area") >= F.greatest("p.area", "q.area") * (least - 1e-9)
    # the cell's hash has the year in it; as a further join key the year would make a bucketed side move
    match = (F.col("p.cell") == F.col("q.cell")) & (F.abs(F.col("p.year") - F.col("q.year")) < 1) & (F.col("p.cls") != F.col("q.cls")) & alike
    shared = F.sum(F.greatest(width, F.lit(0.0)) * F.greatest(height, F.lit(0.0))).alias("_shared")
    need = F.max((F.col("p.area") + F.col("q.area")) * (least / (1 + least) - 1e-9)).alias("_need")
    joined = p.join(q, match).groupBy(F.col("p.cls").alias("a"), F.col("q.cls").alias("b")).agg(shared, need, F.min("q.cell").alias("at"), F.min(f"q.{first}").alias("first"))
    return joined.where("_shared >= _need").drop("_shared", "_need")


def _alike(pairs: DataFrame, own: DataFrame, least: float) -> DataFrame:
    """Of pairs (a, b, ..., edges_b) those whose outlines' common area is at least `least` of their joint area."""
    keep = [c for c in pairs.columns if c != "edges_b"]
    measured = common_areas(pairs.join(own.select(F.col("cls").alias("a"), F.col("edges").alias("edges_a")), "a"), "edges_a", "edges_b")
    return measured.where(F.col("area_both") >= least * (F.col("area_a") + F.col("area_b") - F.col("area_both"))).select(keep)


def _cells_of(outlines: DataFrame, *more: str, own_only: bool = False) -> DataFrame:
    rows = outlines.select("cls", "year", *BOX, *more, F.explode("cells").alias("_c")).select("*", "_c.*").drop("_c")
    return (rows.where("own") if own_only else rows).drop("own")


def _keys_of(rows: DataFrame) -> DataFrame:
    """(rev_key, hash, key) of the exact keys of rows: their id and their outline."""
    key = F.explode(F.array_compact(F.array(F.concat(F.lit("i:"), "id_key"), F.concat(F.lit("o:"), "cls"))))
    return rows.select("rev_key", key.alias("key")).withColumn("hash", F.xxhash64("key"))


def settle(rows: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
    """Rows (rev_key, id_key, cls) one by one, least rev_key first: adds `first`, the first accepted row that each repeats, null
    where it is accepted. near: pairs (a, b) of outlines that count as one."""
    around: dict[str, list[str]] = {}
    for a, b in zip(near["a"], near["b"]):
        around.setdefault(a, []).append(b)
        around.setdefault(b, []).append(a)
    by_id: dict[str, int] = {}
    by_cls: dict[str, int] = {}
    rows = rows.sort_values("rev_key")
    first: list[int | None] = []
    for key, rid, cls in zip(rows["rev_key"], rows["id_key"], rows["cls"]):
        hits = [by_id[rid]] if rid in by_id else []
        if cls is not None:
            hits += [by_cls[c] for c in (cls, *around.get(cls, ())) if c in by_cls]
        first.append(min(hits, default=None))
        if not hits:
            if rid is not None:
                by_id[rid] = key
            if cls is not None:
                by_cls[cls] = key
    return pd.DataFrame({"rev_key": rows["rev_key"].astype("int64"), "id_key": rows["id_key"], "cls": rows["cls"], "first": pd.array(first, "Int64")})


class History:
    """What was accepted, in bucketed tables under a folder that all executors share; a later session opens it again.

    The number of buckets and the least common share are kept beside the tables: opened again, a history has those it was
    made with, and asking for others is an error. Every appended batch adds files; `compact` puts them together.
    """

    TABLES = {
        "keys": ("hash BIGINT, key STRING, first BIGINT", "hash"),
        "cells": (f"cell BIGINT, level INT, cx BIGINT, cy BIGINT, {OUTLINE_DDL}, edges ARRAY<DOUBLE>, first BIGINT", "cell"),
    }

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None, least: float | None = None):
        self.spark = spark
        self.path = path or f"{shared_dir(spark)}/history-{uuid.uuid4().hex}"
        made = self._meta()
        self.empty = made is None
        if made is None:
            made = {"buckets": buckets or shuffle_parts(spark), "least": SAME_AREA if least is None else least, "version": 0}
            self._write_meta(made)
        for what, asked in (("buckets", buckets), ("least", least)):
            if asked is not None and asked != made[what]:
                raise ValueError(f"the history at {self.path} was made with {what} {made[what]}, not {asked}")
        self.buckets, self.least, self.version = made["buckets"], made["least"], made["version"]
        self._open()

    def _meta(self) -> dict | None:
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(f"{self.path}/meta")
        if not at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at):
            return None
        return max((json.loads(r["value"]) for r in self.spark.read.text(f"{self.path}/meta").collect()), key=lambda m: m["version"])

    def _write_meta(self, meta: dict) -> None:
        """One line for each version there has been."""
        self.spark.createDataFrame([(json.dumps(meta),)], "value STRING").coalesce(1).write.mode("append").text(f"{self.path}/meta")

    def _open(self) -> None:
        name = f"history_{uuid.uuid4().hex}"
        self.names = {t: f"{name}_{t}" for t in self.TABLES}
        for table, (ddl, by) in self.TABLES.items():
            self.spark.sql(f"CREATE TABLE {self.names[table]} ({ddl}) USING parquet CLUSTERED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{self.path}/{table}-{self.version}'")

    def close(self) -> None:
        """Forget the tables' names; the files stay."""
        for name in self.names.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def compact(self) -> None:
        """Rewrites the tables with one file a bucket, in a new version; files of the old one stay until they are cleared."""
        old = dict(self.names)
        self.version += 1
        self._open()
        for table, (_, by) in self.TABLES.items():
            self._append(table, self.spark.table(old[table]))
        self._write_meta({"buckets": self.buckets, "least": self.least, "version": self.version})
        for name in old.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _append(self, table: str, rows: DataFrame) -> None:
        by = self.TABLES[table][1]
        rows.repartition(self.buckets, by).select(self.spark.table(self.names[table]).columns).write.insertInto(self.names[table])

    def _lookup(self, rows: DataFrame, own: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
        """(rev_key, first) of the rows that repeat one of what was accepted, given as the history's tables are. Inner joins only:
        rows without an id or outline, however many, go nowhere; the tables stay where they are, what is asked comes to them."""
        held = tables["keys"].select(F.col("hash").alias("_h"), F.col("key").alias("_k"), "first")
        hits = _keys_of(rows).join(held, (F.col("hash") == F.col("_h")) & _same("key", "_k")).select("rev_key", "first")
        pairs = _covering(_cells_of(own), tables["cells"], "first", self.least)
        edges = tables["cells"].select(F.col("cell").alias("_cell"), F.col("cls").alias("_cls"), F.col("edges").alias("edges_b"))
        near = _alike(pairs.join(edges, (F.col("at") == F.col("_cell")) & _same("b", "_cls")).drop("_cell", "_cls"), own, self.least)
        by_outline = near.groupBy(F.col("a").alias("cls")).agg(F.min("first").alias("first"))
        return hits.union(rows.select("rev_key", "cls").join(by_outline, "cls").select("rev_key", "first")).groupBy("rev_key").agg(F.min("first").alias("first"))

    def _as_tables(self, accepted: DataFrame, own: DataFrame) -> dict[str, DataFrame]:
        """Accepted rows (rev_key, id_key, cls) in the form of the tables."""
        keys = _keys_of(accepted).groupBy("hash", "key").agg(F.min("rev_key").alias("first"))
        fresh = own.join(accepted.where("cls IS NOT NULL").groupBy("cls").agg(F.min("rev_key").alias("first")), "cls")
        return {"keys": keys, "cells": _cells_of(fresh, "first", "edges", own_only=True)}

    def _conflicts(self, open_rows: DataFrame, own: DataFrame) -> tuple[DataFrame, bool]:
        """Pairs (a, b) of open outlines alike, b with the earlier first row, among the first of each cell; with a row (a, null)
        for outlines a that have more before them in a cell than were looked at. And whether there is such a row."""
        classes = open_rows.where("cls IS NOT NULL").groupBy("cls").agg(F.min("rev_key").alias("m"))
        mine = own.join(classes, "cls")
        kept, asking = _cells_of(mine, "m", own_only=True), _cells_of(mine, "m")

        def alike(asked: DataFrame, first_ones: DataFrame) -> DataFrame:
            pairs = _covering(asked, first_ones, "m", self.least)
            earlier = pairs.join(classes.select(F.col("cls").alias("a"), "m"), "a").where("first < m").select("a", "b")
            return _alike(earlier.join(own.select(F.col("cls").alias("b"), F.col("edges").alias("edges_b")), "b"), own, self.least)

        # a cell's first ones; the group limit works before the rows move, so a hot cell is no hot task
        ranked = kept.withColumn("_at", F.row_number().over(Window.partitionBy("cell").orderBy("m", "cls"))).where(F.col("_at") <= FIRST_OF_CELL + 1)
        bars = ranked.where(F.col("_at") == FIRST_OF_CELL + 1).select("cell", F.col("m").alias("_bar"))
        behind = asking.join(bars, "cell").where("m > _bar").select(F.col("cls").alias("a"), F.lit(None).cast("string").alias("b")).distinct()
        if self._larger(open_rows, FIRST_OF_CELL):
            behind = stage(behind, "behind")
            if self._larger(behind, 0):
                seen = asking.join(behind.select(F.col("a").alias("cls")), "cls", "left_anti")
                return stage(alike(seen, ranked.where(F.col("_at") <= FIRST_OF_CELL).drop("_at")).select("a", "b").union(behind), "near"), True
        return stage(alike(asking, kept).select("a", "b"), "near"), False

    @staticmethod
    def _larger(rows: DataFrame, than: int) -> bool:
        """Whether a written frame has more rows than that."""
        return rows.limit(than + 1).count() > than

    def check(self, batch: DataFrame) -> DataFrame:
        """(rev_key_a, rev_key_b) of a batch as `read_reviews` and `with_heads` give it, written or cheap to read again: repeats b
        and the first accepted row a they repeat. Accepts the others. Rows are taken in the order of rev_key, which must be unique."""
        rows = batch.select("rev_key", "id_key", "cls")
        own = batch.where("head").select("cls", "year", *BOX, "edges", "cells")
        left, accepted, beaten, repeats = rows, [], [], [rows.select("rev_key", F.col("rev_key").alias("first")).where("false")]
        if not self.empty:
            hits = self._lookup(rows, own, {t: self.spark.table(n) for t, n in self.names.items()})
            known = stage(rows.join(hits, "rev_key", "left"), "known")
            repeats = [known.where("first IS NOT NULL").select("rev_key", "first")]
            left = known.where("first IS NULL").drop("first")
        one = lambda df: df.withColumn("_all", F.lit(0)).groupBy("_all")
        while True:
            near, crowded = self._conflicts(left, own)
            if not crowded and self._larger(left, LOCAL_ROWS):  # rows that meet no other are accepted, the others go on
                twice = lambda c: left.where(f"{c} IS NOT NULL").groupBy(c).agg(F.count("*").alias("_n")).where("_n > 1").select(c)
                tied = near.select(F.explode(F.array("a", "b")).alias("cls")).union(twice("cls")).distinct().withColumn("_tied", F.lit(True))
                marked = left.join(tied, "cls", "left").join(twice("id_key").withColumn("_same", F.lit(True)), "id_key", "left")
                marked = stage(marked.select("rev_key", "id_key", "cls", (F.col("_tied").isNotNull() | F.col("_same").isNotNull()).alias("tied")), "marked")
                accepted.append(marked.where("NOT tied").drop("tied"))
                left = marked.where("tied").drop("tied")
            if not crowded and not self._larger(left, LOCAL_ROWS):
                done = stage(one(left).cogroup(one(near)).applyInPandas(lambda r, n: settle(r, n), "rev_key BIGINT, id_key STRING, cls STRING, first BIGINT"), "settled")
                repeats.append(done.where("first IS NOT NULL").select("rev_key", "first"))
                accepted.append(done.where("first IS NULL").drop("first"))
                break
            # a round: open rows before which no open row has their id or an outline like theirs are accepted
            classes = left.where("cls IS NOT NULL").groupBy("cls").agg(F.min("rev_key").alias("_m"))
            ids = left.where("id_key IS NOT NULL").groupBy("id_key").agg(F.min("rev_key").alias("_i"))
            blocked = near.select(F.col("a").alias("cls"), F.lit(True).alias("_b")).distinct()
            judged = left.join(classes, "cls", "left").join(ids, "id_key", "left").join(blocked, "cls", "left")
            free = "_b IS NULL AND (_m IS NULL OR _m = rev_key) AND (_i IS NULL OR _i = rev_key)"
            now = stage(judged.select("rev_key", "id_key", "cls", F.expr(free).alias("free")), "judged")
            taken, rest = now.where("free").drop("free"), now.where("NOT free").drop("free")
            out = stage(rest.join(self._lookup(rest, own.join(rest.select("cls").distinct(), "cls"), self._as_tables(taken, own)), "rev_key", "left"), "round")
            accepted.append(taken)
            beaten.append(out.where("first IS NOT NULL").drop("first"))
            left = out.where("first IS NULL").drop("first")
        union = lambda frames: frames[0] if len(frames) == 1 else union([a.union(b) for a, b in zip(frames[::2], frames[1::2])] + frames[len(frames) // 2 * 2 :])
        tables = self._as_tables(union([a.select("rev_key", "id_key", "cls") for a in accepted]), own)
        if beaten:  # which of the rounds' accepted rows comes first
            lost = union(beaten)
            repeats.append(stage(self._lookup(lost, own.join(lost.select("cls").distinct(), "cls"), tables), "lost"))
        for table, frame in tables.items():
            self._append(table, frame)
        self.empty = False
        return union(repeats).select(F.col("first").alias("rev_key_a"), F.col("rev_key").alias("rev_key_b"))


def with_heads(read: DataFrame) -> DataFrame:
    """Adds `head`: whether a row is the first of its batch with its outline, which stands for the others."""
    firsts = read.where("cls IS NOT NULL").groupBy("batch", "cls").agg(F.min("rev_key").alias("rev_key")).select("rev_key", F.lit(True).alias("_first"))
    return read.join(firsts, "rev_key", "left").withColumn("head", F.coalesce("_first", F.lit(False))).drop("_first")


def repeats_by_batch(reviews: DataFrame) -> DataFrame:
    """All batches in order, each against the history of those before it: (rev_key_a, rev_key_b).

    Null ids match nothing; a null year or an unreadable or empty outline matches by id only. An empty table gives no rows.
    Rows delivered again under their rev_key count once. The number of batches is small (they are runs of a pipeline); each is one call of History.check.
    """
    read = stage(with_heads(stage(read_reviews(reviews.dropDuplicates(["rev_key"])), "read")), "reviews")
    history = History(reviews.sparkSession)
    found = None
    for row in read.select("batch").distinct().orderBy("batch").collect():  # one row per batch
        more = history.check(read.where(F.col("batch") == row["batch"]))
        found = more if found is None else found.union(more)
    history.close()
    return found if found is not None else reviews.sparkSession.createDataFrame([], "rev_key_a BIGINT, rev_key_b BIGINT")
