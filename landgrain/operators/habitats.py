"""Rule pipelines over parcels, soils, habitats, woodland and farms (H1-H9)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landgrain.functions.text import clean_name, leading_score, slope_score
from landgrain.operators import ranking, tables as T
from landgrain.operators.spatial_join import Grid, durable, sjoin, small_enough
from landgrain.sources.rules import Model, Rule, unmatched, validate

KEY = "id_parcel"

# Habitats treated as rare when found close by, and the ones whose default is acid grassland.
RARE = [
    "lowland raised bog",
    "upland fen",
    "purple moor grass and rush pasture",
    "lowland dry acid grassland",
    "upland calcareous grassland",
    "upland hay meadow",
]
ACID = ["blanket bog", "lowland raised bog", "fragmented heath", "lowland heathland", "mountain heaths and willow scrub", "upland heathland"]


def candidate_habitats(upland: DataFrame, soil: DataFrame, lookup: DataFrame) -> DataFrame:
    """H1: habitats a parcel's soil allows; a lookup row without an upland flag fits both kinds of land."""
    options = lookup.where("source = 'soilscapes'").select(
        F.replace("action_group", F.lit("Create "), F.lit("")).alias("action_group"),
        "action_habitat",
        F.col("is_upland").alias("_wanted"),
        "habitat_code",
        "soilscape_habitat_code",
    )
    soils = upland.join(soil, KEY).where("habitat_code IS NOT NULL")
    joined = _look_up(soils, options, "habitat_code", F.col(KEY))
    fits = F.col("_wanted").isNull() | (F.col("_wanted") == F.col("is_upland"))
    return joined.where(fits).select(KEY, "action_group", "action_habitat", "is_upland", "soilscape_habitat_code", "unit").distinct()


def nearby_habitats(areas: DataFrame, lookup: DataFrame, distances: list[int] = (1_000, 3_000)) -> DataFrame:
    """H2: habitat areas near parcels under the names of the lookup, flagging rare habitats in the closest band.

    The rows of a parcel stay in one partition, so choosing among them needs no further shuffle.
    """
    named = areas.repartition(KEY).withColumn("habitat_name", clean_name("habitat_name")).where(F.col("distance_threshold").isin(*distances))
    names = lookup.where("source = 'phi'").select(
        F.replace("action_group", F.lit("Create "), F.lit("")).alias("action_group"),
        F.col("action_habitat").alias("action_habitat_phi"),
        clean_name("habitat_name").alias("habitat_name"),
        F.col("soilscape_habitat_code").alias("soilscape_habitat_code_phi"),
    ).distinct()
    rare = F.col("habitat_name").isin(*RARE) & (F.col("distance_threshold") == min(distances))
    held = [*names.columns, *[c for c in named.columns if c not in names.columns]]
    found = _look_up(named.where("habitat_name IS NOT NULL"), names, "habitat_name", F.col(KEY))
    return found.select("habitat_name", *[c for c in held if c != "habitat_name"]).withColumn("nearby_rare_habitat", rare)


def unknown_habitats(areas: DataFrame, lookup: DataFrame) -> DataFrame:
    """H2 check: lookup names that occur in no area row."""
    a = areas.select(clean_name("habitat_name").alias("habitat_name"))
    b = lookup.where("source = 'phi'").select(clean_name("habitat_name").alias("habitat_name"))
    return unmatched(b, a, ["habitat_name"])


def _best_matches(candidates: DataFrame, nearby: DataFrame, order: list[Column]) -> DataFrame:
    """Pairs of a candidate and a nearby habitat of its parcel and action group, among them the first of each group in `order`.

    The order asks for equal habitats, then for equal soils, then for columns of one side.  Rows of a
    side with the same habitat and soil therefore differ only in the latter, and the first of them stands
    for all.  Where no pair of a group has both equal, the same holds for rows with the same habitat; where
    none has an equal habitat, for rows with the same soil; where none has either, for all rows.  A null is never
    equal and ranks after unequal, so rows with and without one are kept apart.
    """
    c = F.col
    habitat, soil = ("action_habitat", "action_habitat_phi"), ("soilscape_habitat_code", "soilscape_habitat_code_phi")
    near_order = [*order[2:5], c("habitat_name")]

    def first(side: DataFrame, whole: list[tuple[str, str]], k: int, by: list[Column]) -> DataFrame:
        parts = [t[k] for t in whole]
        split = side.withColumns({f"_null{i}": c(t[k]).isNull() for i, t in enumerate((habitat, soil)) if t not in whole})
        marks = [n for n in split.columns if n not in side.columns]
        return ranking.best_rows(split, [KEY, "action_group", *parts, *marks], by, 1, "_r").drop("_r", *marks)

    cands = durable(first(candidates, [habitat, soil], 0, [c("unit")]))
    near = durable(first(nearby, [habitat, soil], 1, near_order))
    grass = c("action_group") == "SRG"
    pairs = None
    for equal in ([habitat, soil], [habitat], [soil], []):
        left, right = cands, near
        if len(equal) < 2:
            left = first(cands.where(grass), equal, 0, [c("action_habitat"), c("unit")])
            right = first(near.where(grass), equal, 1, near_order)
        right = right.withColumnsRenamed({KEY: "_key", "action_group": "_group"})
        met = (c(KEY) == c("_key")) & (c("action_group") == c("_group"))
        for ours, theirs in equal:
            met = met & (c(ours) == c(theirs))
        one = left.join(right, met).drop("_key", "_group")
        pairs = one if pairs is None else pairs.unionByName(one)
    return pairs


def assign_habitats(candidates: DataFrame, nearby: DataFrame) -> DataFrame:
    """H3: one habitat per parcel and action group.

    Matches between soil and nearby habitat rank first, then nearness, rarity
    and area; grassland parcels without a match get a default.  Remaining ties
    go to the alphabetically first habitat and the smallest soil unit.  Each side is
    ranked before the two meet, so no parcel's candidates meet all its habitats.
    """
    c = F.col
    order = [
        c("matches_action").desc_nulls_last(),
        c("matches_soil").desc_nulls_last(),
        c("distance_threshold").asc_nulls_first(),
        c("nearby_rare_habitat").desc(),
        c("area").desc(),
        c("is_default").desc_nulls_last(),
        c("action_habitat"),
        c("unit"),
    ]
    matched = _best_matches(candidates, nearby, order).withColumns(
        {
            "matches_action": c("action_habitat") == c("action_habitat_phi"),
            "matches_soil": c("soilscape_habitat_code") == c("soilscape_habitat_code_phi"),
        }
    )
    acid = F.coalesce(c("habitat_name").isin(*ACID), F.lit(False))
    default = F.concat(F.when(c("is_upland"), "upland_").otherwise("lowland_"), F.when(acid, "acid_gr").otherwise("meadow"))
    nearest = [c("distance_threshold").asc_nulls_first(), c("area").desc(), c("habitat_name")]
    found = ranking.best_rows(nearby.select(KEY, "habitat_name", "distance_threshold", "area"), [KEY], nearest, 1, "_r").select(KEY, "habitat_name")
    grass = ranking.best_rows(candidates.where(c("action_group") == "SRG"), [KEY, "action_group"], [c("unit")], 1, "_r")
    defaults = grass.join(found, KEY, "left").select(
        KEY, "unit", "action_group", default.alias("action_habitat"), "is_upland", F.lit(True).alias("is_default"), "habitat_name"
    )
    return ranking.best_rows(matched.unionByName(defaults, allowMissingColumns=True), [KEY, "action_group"], order)


ASSIGNMENT = Model(
    columns={KEY: Rule(nullable=False), "action_group": Rule(nullable=False), "action_habitat": Rule(nullable=False)},
    invariants={
        "match or default": "matches_action OR matches_soil OR is_default OR action_group = 'SRG'",
        "no lowland habitat on upland": "NOT (is_upland AND is_default AND action_habitat LIKE 'lowland%')",
        "no upland habitat on lowland": "NOT (NOT is_upland AND is_default AND action_habitat LIKE 'upland%')",
        "defaults are grassland": "NOT (is_default AND action_group != 'SRG')",
        "habitat known unless default": "action_habitat_phi IS NOT NULL OR is_default",
    },
)


def check_assignment(assigned: DataFrame) -> DataFrame:
    """The invariants of an assignment, counted over all rows."""
    return validate(assigned, ASSIGNMENT)


def _grouped_names(names: DataFrame, create: DataFrame, manage: DataFrame) -> DataFrame:
    """(habitat_name, grouping_category, action_group, action_habitat): the groups that a habitat name belongs to."""
    create = create.where("source = 'phi'").select(
        F.replace("action_group", F.lit("Create "), F.lit("")).alias("action_group"), "action_habitat", clean_name("habitat_name").alias("_clean")
    )
    # a total row repeats per habitat of its group; each (group, habitat, name) needs to match once
    create = T.with_subtotals(create, {"action_habitat": "action_group_total"}).distinct()
    joint = manage.where("action_group IN ('Wetland', 'SRG')").withColumns(
        {"action_group": F.lit("Wetland and SRG"), "action_habitat": F.lit("action_group_total")}
    )
    manage = T.with_subtotals(manage, {"action_habitat": "action_group_total"}).unionByName(joint).distinct()
    cols = ["habitat_name", "grouping_category", "action_group", "action_habitat"]
    views = [
        names.withColumns({"action_habitat": F.col("habitat_name"), "action_group": F.lit(None).cast("string"), "grouping_category": F.lit("raw")}),
        names.withColumn("_clean", clean_name("habitat_name")).join(create, "_clean").withColumn("grouping_category", F.lit("create")),
        names.join(manage, "habitat_name").withColumn("grouping_category", F.lit("manage")),
    ]
    return reduce(DataFrame.unionAll, [v.select(*cols) for v in views]).distinct()


LOOKUP_ROWS = 200_000
"""Rows of a lookup that are broadcast; a larger one is joined on salted names."""
SALTS = 64


def _look_up(rows: DataFrame, lookup: DataFrame, on: str, salt: Column) -> DataFrame:
    """Join a lookup whose key has few values: broadcast where it is checked to be small, else each value is spread by `salt`."""
    named = lookup.withColumnRenamed(on, "_on")
    if small_enough(lookup, LOOKUP_ROWS):
        return rows.join(F.broadcast(named), F.col(on).eqNullSafe(F.col("_on"))).drop("_on")
    salted = named.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("_mine", F.pmod(F.xxhash64(salt), F.lit(SALTS)).cast("int"))
    return rows.join(salted, F.col(on).eqNullSafe(F.col("_on")) & (F.col("_mine") == F.col("_salt"))).drop("_on", "_mine", "_salt")


def existing_habitats(parcels: DataFrame, proportions: DataFrame, create: DataFrame, manage: DataFrame) -> DataFrame:
    """H4: habitat share and area per parcel under three groupings, with group totals.

    A feature counts once per parcel and group, with its largest share; shares are capped at
    the parcel.  Groups with the same habitat names have the same shares, so shares are
    summed per set of names and handed to its groups at the end.  Features with one name
    are summed per name before that.  Everything per parcel shares one partitioning.
    """
    names = proportions.select("habitat_name").distinct()
    group = ["grouping_category", "action_group", "action_habitat"]
    sets = _grouped_names(names, create, manage).groupBy(*group).agg(F.array_sort(F.collect_set("habitat_name")).alias("names"))
    sets = durable(sets.withColumn("set", F.xxhash64("names")))
    raw = F.when(F.size("names") == 0, F.array(F.lit(None).cast("string"))).otherwise(F.col("names"))  # a null name is a group of its own
    members = sets.select("set", F.explode(raw).alias("habitat_name")).distinct()

    rows = proportions.select(KEY, "habitat_name", "fid", "proportion").repartition(KEY)
    feats = rows.groupBy(KEY, "fid", "habitat_name").agg(F.max("proportion").alias("proportion"))
    feats = feats.withColumn("_names", F.count(F.lit(1)).over(Window.partitionBy(KEY, "fid")))
    plain = feats.where("_names = 1").groupBy(KEY, "habitat_name").agg(F.sum("proportion").alias("share"))
    plain = _look_up(plain, members, "habitat_name", F.col(KEY)).select(KEY, "set", "share")
    mixed = _look_up(feats.where("_names > 1"), members, "habitat_name", F.col(KEY)).groupBy(KEY, "set", "fid").agg(F.max("proportion").alias("share"))
    shares = plain.unionByName(mixed.drop("fid")).groupBy(KEY, "set").agg(T.clamped_sum("share").alias("proportion")).where("proportion > 0")
    area = parcels.groupBy(KEY).agg(F.min("area_ha").alias("area_ha"))
    out = _look_up(shares.join(area, KEY), sets.select("set", *group), "set", F.col(KEY))
    return out.select(KEY, *group, "proportion", (F.col("area_ha") * F.col("proportion")).alias("habitat_area_ha"))


def soil_habitats(proportions: DataFrame, matrix: DataFrame, unit: str = "unit") -> DataFrame:
    """H5: habitats of each parcel's soils from a table ticked per soil unit and habitat column."""
    habitats = [c for c in matrix.columns if c != unit]
    ticks = T.pivot_long(matrix, habitats, "habitat_code", "tick").where("tick IS NOT NULL AND tick != 0").select(unit, "habitat_code")
    return proportions.join(ticks, unit)


def erosion_scores(parcels: DataFrame, flows: DataFrame, flow_key: str, tie: str = KEY, grid: Grid = Grid()) -> DataFrame:
    """H6: per parcel the worst score of each factor over its flow lines, and the quintile of the worst total."""
    zero = F.lit(0)
    base = flows.select(
        flow_key,
        leading_score(F.col("CatchmentRiskDesc")).alias("CatchmentQuintile"),
        leading_score(F.col("LandUseRisk")).alias("LandUseQuintile"),
        slope_score("SlopeRisk").alias("SlopeQuintile"),
        leading_score(F.col("CombinedSoilRisk")).alias("CombinedSoilQuintile"),
        F.coalesce("MeanRainfalRisk", zero).alias("_rain"),
        F.coalesce("MaxFlowAcc", zero).alias("_flow"),
        "geometry",
    )
    slim = base.select(flow_key, "_rain", "_flow")
    rain = ranking.ntile(slim, "_rain", flow_key, 5, "MeanRainfallQuintile").select(flow_key, "MeanRainfallQuintile")
    flow = ranking.ntile(slim, "_flow", flow_key, 5, "MaxFlowAccQuintile").select(flow_key, "MaxFlowAccQuintile")
    factors = [c + "Quintile" for c in ("Catchment", "LandUse", "Slope", "CombinedSoil", "MeanRainfall", "MaxFlowAcc")]
    scored = base.drop("_rain", "_flow").join(rain, flow_key).join(flow, flow_key)
    scored = scored.withColumn("_score", reduce(lambda a, b: a + b, [F.col(f) for f in factors]))
    held = list(dict.fromkeys([KEY, tie]))
    met = sjoin(parcels.select(*held, "geometry"), scored, grid=grid).groupBy(*held)
    worst = met.agg(F.max("_score").alias("_score"), *[F.max(f).cast("tinyint").alias(f) for f in factors])
    ranked = ranking.ntile(worst.withColumn("_order", F.coalesce("_score", F.lit(-1))), "_order", tie, 5, "erosion_score")
    return ranked.select(KEY, F.col("erosion_score").cast("tinyint").alias("erosion_score"), *factors)


def usable_scenarios(scenarios: DataFrame, tile: str, by: list[str], carbon: list[str], species: list[str]) -> DataFrame:
    """H7: scenario rows with a species, of tiles and scenarios where the sum of a carbon column over the periods is not zero.

    Sums are signed and null sums do not count.  They are taken over all rows, before rows
    without a species go, and compared at 9 decimals, so the order of additions does not matter.
    """
    keys = [tile, *[b for b in by if b != "period"]]
    sums = scenarios.groupBy(*keys).agg(*[F.round(F.sum(c), 9).alias(c) for c in carbon])
    live = sums.where(reduce(lambda a, b: a | b, [F.coalesce(F.col(c) != 0, F.lit(False)) for c in carbon]))
    return scenarios.where(F.coalesce(*species).isNotNull()).join(live, keys, "left_semi")


TASK_ROWS = 250_000
"""Joined rows of a task that aggregates them: their groups are held in memory, and beyond it they are sorted on disk."""


def _by_tile(parcel_tiles: DataFrame, scenarios: DataFrame, tile: str) -> DataFrame:
    """Parcels with the scenarios of their tiles; a parcel stays in one partition, so its many rows are not shuffled again.

    The join makes many rows of one, so the partitions are counted by the rows it makes: by their own size, few
    tasks would aggregate far more groups than fit in memory.
    """
    known = parcel_tiles.where(F.col(tile).isNotNull())
    made = known.groupBy(tile).agg(F.count("*").alias("_n")).join(scenarios.groupBy(tile).agg(F.count("*").alias("_m")), tile)
    rows = made.agg(F.sum(F.col("_n") * F.col("_m"))).first()[0] or 0
    return _look_up(known.repartition(max(known.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)), KEY), scenarios, tile, F.col(KEY))


def woodland_carbon(scenarios: DataFrame, parcel_tiles: DataFrame, tile: str, by: list[str], carbon: list[str], species: list[str], digits: int = 5) -> DataFrame:
    """H7: area-weighted carbon per parcel and scenario over the tiles a parcel lies in."""
    joined = _by_tile(parcel_tiles, usable_scenarios(scenarios, tile, by, carbon, species).select(tile, *by, *carbon), tile)
    return T.weighted_means(joined, [KEY, *by], "area", carbon, digits)


def woodland_species(scenarios: DataFrame, parcel_tiles: DataFrame, tile: str, by: list[str], carbon: list[str], slots: int, digits: int = 5) -> DataFrame:
    """H7: species of each parcel with area-weighted share, yield and suitability; open ground is a species of its own."""
    scenarios = usable_scenarios(scenarios, tile, by, carbon, [f"species_{i}" for i in range(1, slots + 1)])
    c = F.col
    null = F.lit(None).cast("double")
    groups = [
        {"species": c(f"species_{i}"), "share": c(f"area_{i}"), "yield_class": c(f"yield_class_{i}"), "suitability": c(f"suitability_{i}")}
        for i in range(1, slots + 1)
    ]
    groups.append({"species": F.lit("OPENSPACE"), "share": c("open_space"), "yield_class": null, "suitability": null})
    rows = T.stack_structs(scenarios, groups, [tile, *by]).where("species IS NOT NULL")
    return T.weighted_means(_by_tile(parcel_tiles, rows, tile), [KEY, *by, "species"], "area", ["share", "yield_class", "suitability"], digits)


def farm_info(parcels: DataFrame, holdings: DataFrame, farms: DataFrame, arable: list[str], grassland: list[str]) -> DataFrame:
    """H8: per business its parcels, area, mean centre, and crop areas."""
    located = parcels.join(holdings, KEY).groupBy("id_business").agg(
        T.joined_set(KEY).alias("id_parcels"), F.sum("area_ha").alias("area_ha"), F.avg("x").alias("x"), F.avg("y").alias("y")
    )
    crops = farms.select(
        "id_business", T.sum_columns(arable).cast("double").alias("ha_arable"), T.sum_columns(grassland).cast("double").alias("ha_grassland")
    )
    return located.join(crops, "id_business")


def land_cover(covers: DataFrame, names: DataFrame) -> DataFrame:
    """H9: area per parcel and cover name, with the codes that went into it."""
    named = covers.join(names.withColumn("land_cover_name", F.trim("land_cover_name")), "land_cover_code")
    return named.groupBy(KEY, "land_cover_name").agg(
        F.sum("area").alias("area"), T.joined_set("land_cover_code").alias("land_cover_codes")
    )
