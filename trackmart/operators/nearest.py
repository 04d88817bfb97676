"""Nearest-station join: for every point the station at the smallest straight-line
distance, ties going to the smallest ``station_id``.

The product of points and stations is never formed. Space is cut into cubes (cells of ECEF
coordinates), and every occupied cell gets the list of the stations that can be nearest to any
point inside it. Let *m* be the centre of a cell with edge *e* and *t* the station nearest to
*m*. The difference of the squared distances from a point to another station *s* and to *t* is
linear in the point, and over the cell its least value is

    |m - s|^2 - |m - t|^2 - e * (|tx - sx| + |ty - sy| + |tz - sz|),

so *s* stays on the list only while this is not above zero (plus a margin for rounding). The
bound holds at any height, at the poles and across the date line, and it is sharp also far above
crowded stations: lists shrink with the cell, not with the distance.

Lists are worked out from large cells to small ones, each from the list of the cell around it,
beginning at the smallest cells that can meet all stations in ``FIRST_PAIRS`` pairs: with few
stations those are the tiles of 4 km themselves. Below that a tile is cut further, as a whole,
until no list in it is longer than ``leaf_stations``. A point finds its tile's edge, and with the
cell of that edge its list: one key, one join, whatever the level. Occupied cells come from one
scan of the points; larger cells follow by integer division.

``StationIndex`` keeps the lists for points that come in batches, and adds those of cells that
were not occupied before.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmart.functions import geo
from trackmart.runtime import broadcast_if_small, settled
from trackmart.sources.files import exists

LEAF_STATIONS = 64
FIRST_PAIRS = 1 << 22  # of cells and stations, where lists begin
TASK_ROWS = 1 << 13  # entries of lists that one task refines

_CELL = ["cell_x", "cell_y", "cell_z"]
_OUTER = ["outer_x", "outer_y", "outer_z"]
_TILE = ["tile_x", "tile_y", "tile_z"]
_POSITION = ["x_ecef", "y_ecef", "z_ecef"]
_STATION = ["station_id", "name", "station_type", "lat", "lon", "h"]
_STATION_POSITION = ["station_x", "station_y", "station_z"]

_OUTER_EDGES_M = [2.0**22, 2.0**18, 2.0**14]
_TILE_EDGE_M = 2.0**12
_SCAN_EDGE_M = 2.0**6  # edge of the occupied cells that the scan of the points yields
_LAST_EDGE_M = 1.0
_REFINE = 4
_NOWHERE = -(1 << 62)


def nearest_station(points: DataFrame, stations: DataFrame, *, leaf_stations: int = LEAF_STATIONS) -> DataFrame:
    """Enriched points with ``r_to_station`` and the attributes of the nearest station.

    No station at all gives no rows, which the target checks report.
    """
    return _closest(with_candidates(points, stations, leaf_stations), points.columns)


def _closest(points: DataFrame, columns: list[str]) -> DataFrame:
    """Of each point's candidates the closest one."""
    measured = points.withColumn("distances", F.expr(_distances()))
    # Lists are sorted by id, so the first of several equal minima is the tie-break winner.
    return measured.selectExpr(
        *columns,
        "array_min(distances) AS r_to_station",
        "element_at(candidates, CAST(array_position(distances, array_min(distances)) AS INT)) AS best",
    ).selectExpr(*columns, "r_to_station", *[f"best.{c} AS {c}" for c in _STATION])


def nearest_station_window(points: DataFrame, stations: DataFrame, **limits: int) -> DataFrame:
    """The same answer by numbering: candidates become rows, each point's are put in order,
    and the first one is taken. Shuffles the points; meant for checking ``nearest_station``."""
    here = geo.Ecef(*[F.col(c) for c in _POSITION])
    option = F.transform(
        "candidates", lambda s: F.struct(geo.distance(here, _site_position(s)).alias("away"), s["station_id"].alias("id"), s.alias("site"))
    )
    options = with_candidates(points, stations, **limits).withColumn("option", F.explode(option)).drop("candidates")
    in_order = Window.partitionBy("snapshot_ts", "icao24").orderBy("option.away", "option.id")
    first = options.withColumn("number", F.row_number().over(in_order)).where("number = 1")
    return first.select(*points.columns, F.col("option.away").alias("r_to_station"), *[F.col(f"option.site.{c}").alias(c) for c in _STATION])


def station_distance(points: DataFrame, stations: DataFrame) -> DataFrame:
    """Straight-line distance from each point to the station named in its ``station_id``."""
    here, there = (geo.Ecef(*[F.col(c) for c in names]) for names in (_POSITION, _STATION_POSITION))
    side = broadcast_if_small(stations.select("station_id", *_STATION_POSITION))
    return points.join(side, "station_id").withColumn("station_distance", geo.distance(here, there)).drop(*_STATION_POSITION)


class Lists(NamedTuple):
    """What is known about the occupied part of space; every table is stored."""

    edges: DataFrame | None  # tile, edge: the edge of the cells in each tile that is cut
    entries: DataFrame  # edge, cell, number, position: per occupied cell the stations on its list
    tiles: DataFrame  # tile, number, position: the lists of the tiles as a whole
    sites: DataFrame  # number, site


def with_candidates(points: DataFrame, stations: DataFrame, leaf_stations: int = LEAF_STATIONS) -> DataFrame:
    """Points with ``candidates``: an array of stations that holds their nearest one."""
    found = candidate_lists(points, stations, leaf_stations)
    lists = settled(_arrays(found.entries, found.sites), "candidates")
    return _keyed(points, found.edges).join(broadcast_if_small(lists), ["edge", *_CELL]).select(*points.columns, "candidates")


def _keyed(points: DataFrame, edges: DataFrame | None) -> DataFrame:
    """Points with the edge and the place of the cell whose list they take."""
    placed = points.withColumn("edge", F.lit(_TILE_EDGE_M))
    if edges is not None:
        placed = points.withColumns(_named(_TILE, _keys(_TILE_EDGE_M))).join(broadcast_if_small(edges), _TILE, "left")
        placed = placed.withColumn("edge", F.coalesce("edge", F.lit(_TILE_EDGE_M))).drop(*_TILE)
    return placed.withColumns(_named(_CELL, _keys(F.col("edge"))))


def _arrays(entries: DataFrame, sites: DataFrame) -> DataFrame:
    """The lists as arrays of stations, by id."""
    named = entries.select("edge", *_CELL, "number").join(broadcast_if_small(sites.select("number", "site")), "number")
    return named.groupBy("edge", *_CELL).agg(F.sort_array(F.collect_list("site")).alias("candidates"))


def candidate_lists(points: DataFrame, stations: DataFrame, leaf_stations: int = LEAF_STATIONS, first_pairs: int = FIRST_PAIRS) -> Lists:
    """The lists of all cells that the points lie in."""
    return lists_of(points, settled(sites_of(stations), "sites"), leaf_stations, first_pairs)


def lists_of(points: DataFrame, sites: DataFrame, leaf_stations: int = LEAF_STATIONS, first_pairs: int = FIRST_PAIRS) -> Lists:
    """``candidate_lists`` for stations that are numbered and stored."""
    occupied = settled(points.select(*[c.alias(n) for n, c in zip(_CELL, _position_cells(_SCAN_EDGE_M))]).distinct(), "occupied")

    def cells(edge: float, *around: tuple[list[str], float]) -> DataFrame:
        """Occupied cells of an edge with the cells or tiles of other edges around them."""
        if edge >= _SCAN_EDGE_M:
            source, at = occupied, [F.col(c) for c in _CELL]
            scale = _SCAN_EDGE_M
        else:
            source, at, scale = points, [F.col(c) for c in _POSITION], 1.0
        return source.select(
            *[F.floor(x / (e / scale)).alias(n) for names, e in ((_CELL, edge), *around) for n, x in zip(names, at)]
        ).distinct()

    levels = [*_OUTER_EDGES_M, _TILE_EDGE_M]
    sizes = [F.approx_count_distinct(F.struct(*[F.floor(F.col(c) / (e / _SCAN_EDGE_M)) for c in _CELL])) for e in levels]
    occupied_cells = occupied.agg(*[n.alias(f"n{i}") for i, n in enumerate(sizes)]).first()
    n_sites = sites.count()
    # the smallest cells that meet all stations in few pairs; the answer is the same from any level on
    start = max((i for i, n in enumerate(occupied_cells) if n * n_sites <= first_pairs), default=0)

    whole = {n: F.lit(0).cast("bigint") for n in _OUTER}
    positions = broadcast_if_small(sites.select("number", *_STATION_POSITION))
    lists, outer_edge = sites.select("number", *_STATION_POSITION).withColumns(whole), None
    for edge in levels[start:]:
        inner = cells(edge).withColumns(whole) if outer_edge is None else cells(edge, (_OUTER, outer_edge))
        lists = settled(_shortened(settled(inner, "cells"), lists, _OUTER, positions, edge), "lists").drop(*_OUTER)
        lists, outer_edge = lists.withColumnsRenamed(dict(zip(_CELL, _OUTER))), edge

    tiles = lists.withColumnsRenamed(dict(zip(_OUTER, _TILE)))
    current = tiles.withColumns({c: F.col(t) for c, t in zip(_CELL, _TILE)})
    edge, edges, entries = _TILE_EDGE_M, [], []
    while True:
        sizes = current.groupBy(*_TILE, *_CELL).agg(F.count("*").alias("n"))
        longest = sizes.agg(F.max("n")).first()[0] or 0
        done = longest <= leaf_stations or edge <= _LAST_EDGE_M
        if not done:
            cut = settled(sizes.where(F.col("n") > leaf_stations).select(*_TILE).distinct(), "cut")
            cut_side = broadcast_if_small(cut)
        kept = (current if done else current.join(cut_side, _TILE, "left_anti")).withColumn("edge", F.lit(edge))
        entries.append(kept.select("edge", *_CELL, "number", *_STATION_POSITION))
        if edge < _TILE_EDGE_M:
            edges.append(kept.select(*_TILE, "edge").distinct())
        if done:
            break
        finer = edge / _REFINE
        inside = settled(cells(finer, (_OUTER, edge), (_TILE, _TILE_EDGE_M)).join(cut_side, _TILE, "left_semi"), "cells")
        outer = current.join(cut_side, _TILE, "left_semi").drop(*_TILE).withColumnsRenamed(dict(zip(_CELL, _OUTER)))
        current, edge = settled(_shortened(inside, outer, _OUTER, positions, finer), "lists").drop(*_OUTER), finer
    whole_edges = settled(reduce(DataFrame.unionByName, edges), "edges") if edges else None
    return Lists(whole_edges, reduce(DataFrame.unionByName, entries), tiles, sites)


class StationIndex:
    """Lists of candidates that are kept below ``path`` and grow with the space that points occupy.

    A batch finds the lists of known cells by one join. Only points in tiles that are new start a
    refinement; a cell that is new in a tile already cut gets its list from the tile's. What a
    batch adds stands under its number, so that a replay replaces it. An index belongs to one set
    of stations, by the checksum of their positions; other stations begin another one.
    """

    def __init__(self, path: str, stations: DataFrame, leaf_stations: int = LEAF_STATIONS):
        self.leaf_stations = leaf_stations
        positions = f"bit_xor(xxhash64({', '.join([*_STATION, *_STATION_POSITION])}))"
        n, checksum = stations.agg(F.count("*"), F.expr(positions)).first()
        self.path = f"{path}/stations={n}-{(checksum or 0) & (1 << 64) - 1:016x}"
        if not exists(stations.sparkSession, f"{self.path}/sites/_SUCCESS"):
            sites_of(stations).write.mode("overwrite").parquet(f"{self.path}/sites")
        self.sites = stations.sparkSession.read.parquet(f"{self.path}/sites")
        site = [self.sites.schema[c] for c in ("number", *_STATION_POSITION)]
        edge = T.StructField("edge", T.DoubleType())
        tile, cell = ([T.StructField(c, T.LongType()) for c in names] for names in (_TILE, _CELL))
        candidates = T.StructField("candidates", T.ArrayType(self.sites.schema["site"].dataType))
        self.schemas = {
            "edges": T.StructType([*tile, edge]),
            "lists": T.StructType([edge, *cell, candidates]),
            "tiles": T.StructType([*tile, *site]),
        }

    def _read(self, spark: SparkSession, name: str) -> DataFrame:
        folder, schema = f"{self.path}/{name}", self.schemas[name]
        if not exists(spark, folder):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(folder)

    def _add(self, rows: DataFrame, name: str, epoch: int, part: str) -> None:
        rows.select(*self.schemas[name].names).write.mode("overwrite").parquet(f"{self.path}/{name}/{part}-{epoch}")

    def extend(self, points: DataFrame, epoch: int) -> int:
        """Adds the lists of cells that no list is known of; returns how many steps that took."""
        spark, steps = points.sparkSession, 0
        known = broadcast_if_small(self._read(spark, "edges"))
        placed = points.withColumns(_named(_TILE, _keys(_TILE_EDGE_M)))
        fresh = placed.join(known, _TILE, "left_anti").drop(*_TILE)
        if not fresh.isEmpty():
            found = lists_of(fresh, self.sites, self.leaf_stations)
            tiles = found.tiles.select(*_TILE).distinct().withColumn("whole", F.lit(_TILE_EDGE_M))
            if found.edges is not None:
                tiles = tiles.join(found.edges, _TILE, "left")
                self._add(found.tiles.join(found.edges, _TILE, "left_semi"), "tiles", epoch, "tiles")
            edge = F.coalesce("edge", "whole") if found.edges is not None else F.col("whole")
            self._add(_arrays(found.entries, self.sites), "lists", epoch, "tiles")
            self._add(tiles.withColumn("edge", edge), "edges", epoch, "tiles")
            steps += 1
        # cells that are new in tiles already cut
        cut = self._read(spark, "edges").where(F.col("edge") < _TILE_EDGE_M)
        inside = placed.join(broadcast_if_small(cut), _TILE).withColumns(_named(_CELL, _keys(F.col("edge"))))
        cells = inside.select(*_TILE, "edge", *_CELL).distinct()
        new = settled(cells.join(self._read(spark, "lists").select("edge", *_CELL), ["edge", *_CELL], "left_anti"), "new-cells")
        if not new.isEmpty():
            positions = broadcast_if_small(self.sites.select("number", *_STATION_POSITION))
            lists = _shortened(new, self._read(spark, "tiles"), _TILE, positions, F.col("edge"))
            self._add(_arrays(lists, self.sites), "lists", epoch, "cells")
            steps += 1
        return steps

    def nearest(self, points: DataFrame, epoch: int) -> DataFrame:
        """``nearest_station`` of a batch, by the lists kept."""
        spark = points.sparkSession
        self.extend(points, epoch)
        keyed = _keyed(points, self._read(spark, "edges"))
        lists = self._read(spark, "lists").join(broadcast_if_small(settled(keyed.select("edge", *_CELL).distinct(), "cells")), ["edge", *_CELL], "left_semi")
        # a replayed batch may have left a list twice
        met = keyed.join(broadcast_if_small(settled(lists.dropDuplicates(["edge", *_CELL]), "lists")), ["edge", *_CELL])
        return _closest(met.select(*points.columns, "candidates"), points.columns)


def sites_of(stations: DataFrame) -> DataFrame:
    """One row per distinct position, represented by its smallest ``station_id`` (which
    wins every tie among them), with a number of its own once it is stored."""
    site = F.struct(*_STATION, *_STATION_POSITION)
    distinct = stations.groupBy(*_STATION_POSITION).agg(F.min(site).alias("site"))
    return distinct.select(F.monotonically_increasing_id().alias("number"), *_STATION_POSITION, "site")


def _shortened(cells: DataFrame, lists: DataFrame, on: list[str], sites: DataFrame, edge: float | Column) -> DataFrame:
    """Every cell with those stations of its outer list that can be nearest to a point inside it.

    Only the number of each cell's nearest station is exchanged, in fixed-width buffers. Pairs
    are made twice, first to find it and then to keep what is near it, and never leave the task
    that makes them: lists meet a broadcast of the cells, or, where these are too many, the cells
    of their outer cell, by which all of it is dealt. Lists are a short table with many pairs to a
    row, so their tasks go by rows, not by bytes.
    """
    side = broadcast_if_small(cells)
    if side is not cells:
        lists = _spread(lists)
    centre = [(F.col(c) + 0.5) * edge for c in _CELL]
    at = [F.col(c) for c in _STATION_POSITION]
    squares = sum(((m - s) * (m - s) for m, s in zip(centre, at)), F.lit(0.0))

    def met(cells: DataFrame) -> DataFrame:
        return cells.join(lists, on).withColumn("d2", squares)

    nearest = met(side).groupBy(*cells.columns).agg(F.min("d2").alias("near_d2"), F.min_by("number", "d2").alias("near"))
    placed = sites.select(F.col("number").alias("near"), *[s.alias(f"near_{c}") for s, c in zip(at, "xyz")])
    closest = nearest.join(placed, "near").drop("near")
    apart = sum((F.abs(F.col(f"near_{c}") - s) for s, c in zip(at, "xyz")), F.lit(0.0))
    margin = 1e-3 + 1e-13 * (F.col("d2") + F.col("near_d2"))
    kept = met(closest if side is cells else F.broadcast(closest))
    return kept.where(F.col("d2") - F.col("near_d2") <= edge * apart + margin).select(*cells.columns, "number", *_STATION_POSITION)


def _spread(lists: DataFrame) -> DataFrame:
    """Lists dealt to tasks of some thousand rows."""
    tasks = -(-lists.count() // TASK_ROWS)
    return lists.repartition(tasks, "number") if tasks > 1 else lists


def _keys(edge: float | Column) -> list[Column]:
    """The cell of a point, to look it up by; one that no list has where there is no position.

    Keys that can be null would let Spark filter the points by them first, below the projections:
    a filter that repeats every formula from the raw columns on, in a method too long to be compiled.
    """
    return [F.coalesce(F.floor(F.col(c) / edge), F.lit(_NOWHERE)) for c in _POSITION]


def _position_cells(edge: float) -> list[Column]:
    return [F.floor(F.col(c) / edge) for c in _POSITION]


def _named(names: list[str], columns: list[Column]) -> dict[str, Column]:
    return dict(zip(names, columns))


def _site_position(site: Column) -> geo.Ecef:
    return geo.Ecef(*[site.getField(c) for c in _STATION_POSITION])


def _distances() -> str:
    """SQL text: the distance from a point to each of its candidates."""
    squares = [f"pow({p} - s.{c}, 2)" for p, c in zip(_POSITION, _STATION_POSITION)]
    return f"transform(candidates, s -> sqrt({' + '.join(squares)}))"
