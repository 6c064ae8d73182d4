"""Reference data: validation, eligibility and classification of candidate places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import cast, text
from ..sources.tables import stored

# ---- Fixed values that results depend on ----
TAGS = ("tourism", "natural", "historic", "leisure")
DIRECT = {
    "tourism": ("aquarium", "hotel", "museum", "resort", "theme_park", "viewpoint", "zoo"),
    "natural": ("beach", "cave_entrance", "waterfall"),
    "historic": ("archaeological_site", "castle", "fort", "monument", "ruins"),
    "leisure": ("water_park",),
}
CONDITIONAL = {
    "tourism": ("attraction", "artwork", "gallery", "arts_centre"),
    "natural": ("cape", "peak"),
    "historic": ("building", "memorial"),
    "leisure": ("garden", "park"),
}
EVIDENCE = ("wikidata", "wikipedia", "website", "image")
BUSINESS = ("shop", "craft", "office")
EXCLUDED_AMENITIES = ("convenience", "copyshop")
RULE_VERSION = "tourism-eligibility-v1"
TAXONOMY = (
    ("natural", "landscape", "mountain", "Núi", "Mountain"),
    ("natural", "landscape", "waterfall", "Thác", "Waterfall"),
    ("natural", "landscape", "cave", "Hang động", "Cave"),
    ("natural", "coastal", "beach", "Biển", "Beach"),
    ("natural", "coastal", "cape", "Mũi đất", "Cape"),
    ("heritage", "historical", "monument", "Di tích", "Monument"),
    ("heritage", "historical", "ruins", "Di tích đổ nát", "Ruins"),
    ("heritage", "historical", "archaeological_site", "Di chỉ khảo cổ", "Archaeological Site"),
    ("heritage", "historical", "historic_building", "Công trình lịch sử", "Historic Building"),
    ("heritage", "religious", "temple", "Chùa/đền", "Temple"),
    ("culture", "museum", "museum", "Bảo tàng", "Museum"),
    ("culture", "arts", "gallery", "Phòng trưng bày", "Gallery"),
    ("recreation", "park", "public_park", "Công viên", "Public Park"),
    ("recreation", "amusement", "theme_park", "Công viên chủ đề", "Theme Park"),
    ("recreation", "amusement", "water_park", "Công viên nước", "Water Park"),
    ("recreation", "amusement", "zoo", "Vườn thú", "Zoo"),
    ("scenic", "viewpoint", "viewpoint", "Điểm ngắm cảnh", "Viewpoint"),
    ("other", "attraction", "general_attraction", "Điểm tham quan", "General Attraction"),
    ("accommodation", "hotel", "hotel", "Khách sạn", "Hotel"),
)
#: (tag, value) -> subcategory.
RULES = {
    ("natural", "peak"): "mountain", ("natural", "waterfall"): "waterfall", ("natural", "cave_entrance"): "cave", ("natural", "beach"): "beach", ("natural", "cape"): "cape",
    ("natural", "spring"): "waterfall", ("natural", "hot_spring"): "waterfall", ("natural", "cliff"): "mountain",
    ("historic", "monument"): "monument", ("historic", "memorial"): "monument", ("historic", "ruins"): "ruins", ("historic", "archaeological_site"): "archaeological_site",
    ("historic", "building"): "historic_building", ("historic", "castle"): "monument", ("historic", "fort"): "monument", ("historic", "heritage"): "monument",
    ("tourism", "museum"): "museum", ("tourism", "hotel"): "hotel", ("tourism", "gallery"): "gallery", ("tourism", "artwork"): "gallery", ("tourism", "aquarium"): "zoo",
    ("tourism", "viewpoint"): "viewpoint", ("tourism", "theme_park"): "theme_park", ("tourism", "zoo"): "zoo",
    ("leisure", "park"): "public_park", ("leisure", "garden"): "public_park", ("leisure", "nature_reserve"): "public_park", ("leisure", "water_park"): "water_park",
}
FALLBACK = "general_attraction"
#: Names that may be no destination.
SUSPICIOUS = r"(?i)^((group|block|section|area|zone)\s+[a-z0-9]+|[a-h]\d+)$"
# ---- End of fixed values ----


def taxonomy(spark: SparkSession) -> DataFrame:
    """The taxonomy with ids CAT001, CAT002, ..."""
    rows = [(f"CAT{k:03d}", *row) for k, row in enumerate(TAXONOMY, 1)]
    return spark.createDataFrame(rows, "category_id string, category_group string, category_name string, subcategory_name string, name_vi string, name_en string")


def validate_basic(df: DataFrame) -> DataFrame:
    """validation_status and validation_reason; of several faults the last of the list below names the reason."""
    blank = F.col("place_name").isNull() | (F.trim("place_name") == "")
    faults = [("missing_osm_id", F.col("osm_id").isNull()), ("missing_name", blank), ("missing_coordinates", F.col("latitude").isNull() | F.col("longitude").isNull()), ("invalid_latitude", F.abs("latitude") > 90), ("invalid_longitude", F.abs("longitude") > 180)]
    reason = F.lit("")
    for name, fault in faults:
        reason = F.when(F.coalesce(fault, F.lit(False)), name).otherwise(reason)
    return df.withColumn("validation_reason", reason).withColumn("validation_status", F.when(F.col("validation_reason") == "", "valid").otherwise("invalid"))


def reject_repeats(df: DataFrame, order: str) -> DataFrame:
    """A map object's later rows become invalid, if still valid."""
    seen = F.row_number().over(Window.partitionBy("osm_type", "osm_id").orderBy(order)) > 1
    out = df.withColumn("_again", seen & (F.col("validation_status") == "valid"))
    return out.withColumns({"validation_status": F.when(F.col("_again"), "invalid").otherwise(F.col("validation_status")), "validation_reason": F.when(F.col("_again"), "duplicate_osm_object").otherwise(F.col("validation_reason"))}).drop("_again")


def suspect_names(df: DataFrame) -> DataFrame:
    """Names of a suspicious form go to review, unless invalid; an earlier reason stays."""
    odd = (F.col("validation_status") != "invalid") & F.trim("place_name").rlike(SUSPICIOUS)
    odd = F.coalesce(odd, F.lit(False))
    return df.withColumns({"validation_reason": F.when(odd & (F.col("validation_reason") == ""), "suspicious_name").otherwise(F.col("validation_reason")), "validation_status": F.when(odd, "review").otherwise(F.col("validation_status"))})


def suspect_namesakes(df: DataFrame) -> DataFrame:
    """Valid rows that share name and province with any other row, whatever that one's status, go to review. Blank names share nothing."""
    name = F.regexp_replace(F.lower(F.coalesce("place_name", F.lit(""))), r"(?U)^\s+|\s+$", "")
    shared = F.count(F.lit(1)).over(Window.partitionBy("province_id", "_name")) > 1
    out = df.withColumn("_name", name).withColumn("_same", shared & (F.col("_name") != "") & (F.col("validation_status") == "valid"))
    return out.withColumns({"validation_status": F.when(F.col("_same"), "review").otherwise(F.col("validation_status")), "validation_reason": F.when(F.col("_same"), "duplicate_name").otherwise(F.col("validation_reason"))}).drop("_same", "_name")


def eligibility(tags_json: Column, fields: dict[str, Column]) -> Column:
    """A struct of tourism_status, _reason, _evidence, _confidence and _rule_version, by the first rule that holds.

    ``fields``: the columns of the row besides the tags, by name (the four tag columns, and evidence columns if any).
    """
    found = cast.tags_of(tags_json, {k: fields[k] for k in TAGS if k in fields})
    return cast.once(found, lambda t: ruled(t["tags"], t["malformed"], fields))


def ruled(tags: Column, malformed: Column, fields: dict[str, Column]) -> Column:
    tag = lambda k: F.coalesce(tags[k], F.lit(""))
    names = [F.when((tag(f) != "") | (cast.given(fields[f]).isNotNull() if f in fields else F.lit(False)), f) for f in EVIDENCE]
    evidence = F.array_join(F.array_compact(F.array(*names)), ",")
    excluded = F.array_join(F.array_compact(F.array(*[F.when(tag(f) != "", f) for f in (*BUSINESS, "amenity")])), ",")
    business = (F.greatest(*[tag(f) for f in BUSINESS]) != "") | tag("amenity").isin(*EXCLUDED_AMENITIES)
    direct = F.coalesce(*[F.when(tag(k).isin(*v), F.concat(F.lit(f"{k}="), tag(k))) for k, v in DIRECT.items()])
    pairs = sorted((k, v) for k, values in CONDITIONAL.items() for v in values)
    conditional = F.coalesce(*[F.when(tag(k) == v, f"{k}={v}") for k, v in pairs])

    def result(status: str, reason: str, proof, confidence: str) -> Column:
        proof = F.lit(proof) if isinstance(proof, str) else proof
        return F.struct(F.lit(status).alias("tourism_status"), F.lit(reason).alias("tourism_reason"), proof.alias("tourism_evidence"), F.lit(confidence).alias("tourism_confidence"), F.lit(RULE_VERSION).alias("tourism_rule_version"))

    return (
        F.when(malformed, result("review", "malformed_tags_json", "tags_json", "low"))
        .when(business & ~tag("tourism").isin(*DIRECT["tourism"]), result("rejected", "non_destination_business", excluded, "high"))
        .when(direct.isNotNull(), result("eligible", "strong_tourism_tag", direct, "high"))
        .when(conditional.isNotNull() & (evidence != ""), result("eligible", "conditional_tag_with_independent_evidence", F.concat_ws(";", conditional, evidence), "medium"))
        .when(conditional.isNotNull(), result("review", "conditional_tag_needs_evidence", conditional, "low"))
        .otherwise(result("rejected", "no_supported_tourism_signal", "", "high"))
    )


def crawl_eligible() -> Column:
    return (F.col("validation_status") == "valid") & (F.col("tourism_status") == "eligible")


def classify(df: DataFrame, key: str = "place_id") -> DataFrame:
    """A row a place and category: tags in the order of TAGS, each category once, the first one primary."""
    spark = df.sparkSession
    rules = F.broadcast(spark.createDataFrame([(k, v, s) for (k, v), s in RULES.items()], "tag string, value string, subcategory_name string"))  # a fixed table
    pairs = df.select(key, F.posexplode(F.array(*[F.struct(F.lit(t).alias("tag"), F.trim(F.col(t)).alias("value")) for t in TAGS])).alias("pos", "t"))
    found = pairs.join(rules, (F.col("t.tag") == F.col("tag")) & (F.col("t.value") == F.col("value"))).select(key, "pos", "subcategory_name")
    none = df.select(key).join(found.select(key), key, "left_anti").select(key, F.lit(0).alias("pos"), F.lit(FALLBACK).alias("subcategory_name"))
    each = found.unionByName(none).groupBy(key, "subcategory_name").agg(F.min("pos").alias("pos"))
    first = F.row_number().over(Window.partitionBy(key).orderBy("pos", "subcategory_name")) == 1
    return each.withColumn("is_primary", first).join(F.broadcast(taxonomy(spark)), "subcategory_name").select(key, "category_id", "category_group", "category_name", "subcategory_name", "is_primary")


LEGACY = ("legacy_province_id", "legacy_province_name")
#: Rows of the result that a piece of a province makes, about, and pieces and tasks at most: with more rows, pieces grow.
PIECE, TASKS = 2_000_000, 4096
#: Rows of the mapping in a piece, about: a row of the table meets them in turn, and files compress what so repeats within a few KB.
COLUMN = 1000


def enrich_admin(df: DataFrame, mapping: DataFrame | None) -> DataFrame:
    """Current provinces from the plain ones where the table has none, and missing legacy ids and names from a mapping.

    The mapping (current_province_id, legacy_province_id, legacy_province_name) may have many rows for a province, which
    then has a row for each. It is not joined if no row of the table misses anything. A province whose result has more
    than PIECE rows is cut into pieces over the cluster, each of some of its rows and some of the mapping's.
    """
    null, have = F.lit(None).cast("string"), {c.lower() for c in df.columns}
    plain = {f"current_{c}": F.col(c) if c in have else null for c in ("province_id", "province_name")} | {c: null for c in LEGACY}
    out = df.withColumns({c: v for c, v in plain.items() if c not in have})
    if mapping is None or out.where(F.col(LEGACY[0]).isNull() | F.col(LEGACY[1]).isNull()).isEmpty():
        return out
    m = mapping.select(F.col("current_province_id").alias("_current"), *[F.col(c).alias(f"_{c}") for c in LEGACY])
    n, rows_of = F.count(F.lit(1)), lambda df: F.xxhash64(*[F.col(c) for c, t in df.dtypes if not t.startswith("map")])
    sizes = out.groupBy(F.col("current_province_id").alias("_p")).agg(n.alias("_n")).join(m.groupBy("_current").agg(n.alias("_m")), F.col("_p").eqNullSafe(F.col("_current")))
    sizes = stored(sizes.select("_p", "_n", "_m"), "province-sizes")
    whole = sizes.agg(F.sum(F.col("_n") * F.col("_m"))).first()[0] or 0
    pieces = F.ceil(F.col("_n") * F.col("_m") / max(PIECE, -(-whole // TASKS)))
    # a grid of the table's rows by the mapping's: neither side is repeated for all pieces of the other
    grid = sizes.withColumn("_pieces", pieces).where("_pieces > 1").withColumn("_across", F.least("_pieces", F.ceil(F.col("_m") / COLUMN)))
    grid = grid.withColumn("_down", F.least("_n", F.ceil(F.col("_pieces") / F.col("_across"))))
    many = grid.agg(F.sum(F.col("_down") * F.col("_across"))).first()[0]
    if many:
        key = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit(""))
        side = grid.select(key("_p").alias("_key"), "_down", "_across")
        each = lambda among: F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(among, F.lit(1)) - 1))
        at = ["_key", "_row", "_column"]
        # a shuffle that is not coalesced deals the pieces to as many tasks
        out = out.withColumn("_row", rows_of(out)).withColumn("_key", key("current_province_id")).join(side, "_key", "left")
        out = out.withColumn("_row", F.pmod("_row", F.coalesce("_down", F.lit(1)))).withColumn("_column", each("_across")).drop("_down").repartition(int(min(many, TASKS)), *at)
        m = m.withColumns({"_column": rows_of(m), "_key": key("_current"), "_found": F.lit(True)}).join(side, "_key", "left")
        m = m.withColumn("_column", F.pmod("_column", F.coalesce("_across", F.lit(1)))).withColumn("_row", each("_down")).drop("_down", "_across", "_current")
        # a province that is cut has a mapping, so a row that meets none of it in a piece meets it in others
        joined = out.join(m.hint("merge"), at, "left").where("_across IS NULL OR _found").drop(*at, "_across", "_found")
    else:
        joined = out.join(m, out["current_province_id"].eqNullSafe(m["_current"]), "left").drop("_current")
    return joined.withColumns({c: F.coalesce(c, f"_{c}") for c in LEGACY}).drop(*[f"_{c}" for c in LEGACY])


def review_queue(places: DataFrame) -> DataFrame:
    """Places that someone has to look at: not eligible, or not valid."""
    return places.where(F.col("tourism_status").isin("review", "rejected") | ~F.col("validation_status").eqNullSafe("valid"))


def eligibility_report(places: DataFrame) -> DataFrame:
    """place_count by province, status and reason; null is a value of its own."""
    return places.groupBy("province_id", "province_name", "tourism_status", "tourism_reason").agg(F.count(F.lit(1)).alias("place_count"))


def stable_id(osm_type: Column, osm_id: Column) -> Column:
    return F.concat_ws("_", F.lit("OSM"), osm_type, osm_id)


ELEMENT = "struct<type:string,id:bigint,lat:double,lon:double,center:struct<lat:double,lon:double>,tags:map<string,string>>"


def elements(df: DataFrame, run_id: str, crawled_at: Column, scope: str | None = None, json: str = "element") -> DataFrame:
    """Candidate rows of stored map elements, beside the other columns of their rows.

    The name is the first there is of name, name:vi and name:en; elements without one go. A node stands at its own
    coordinates, anything else at its centre. Tags are kept as they are, and as JSON.
    """
    e = df.withColumn("e", F.from_json(json, ELEMENT))
    tag = lambda k: F.nullif(F.col("e.tags")[k], F.lit(""))
    node = F.col("e.type") == "node"
    place = lambda k: F.when(node, F.col(f"e.{k}")).otherwise(F.col(f"e.center.{k}"))
    out = e.select(
        *[c for c in df.columns if c != json], F.col("e.id").alias("osm_id"), F.col("e.type").alias("osm_type"), F.coalesce(tag("name"), tag("name:vi"), tag("name:en")).alias("place_name"), F.col("e.tags")["name:vi"].alias("name_vi"), F.col("e.tags")["name:en"].alias("name_en"), *[F.col("e.tags")[k].alias(k) for k in TAGS],
        place("lat").alias("latitude"), place("lon").alias("longitude"), F.coalesce(tag("website"), tag("contact:website")).alias("website"), *[F.col("e.tags")[k].alias(k) for k in ("wikidata", "wikipedia")], F.coalesce(F.to_json("e.tags"), F.lit("{}")).alias("tags_json"),
        F.lit("OpenStreetMap").alias("source"), F.lit(scope).cast("string").alias("discovery_scope"), F.lit(run_id).alias("pipeline_run_id"), crawled_at.cast("string").alias("crawled_at_utc"),
    )
    return out.where("place_name IS NOT NULL")


COLLECTION = "struct<bbox:array<double>,features:array<struct<id:string,bbox:array<double>,properties:map<string,string>>>>"


def province_features(df: DataFrame, json: str = "collection") -> DataFrame:
    """Id, name and bounding box of the first feature of stored collections, by chains of fallbacks; collections without one go."""
    f = df.withColumn("c", F.from_json(json, COLLECTION)).where(F.size("c.features") > 0).withColumn("f", F.get("c.features", F.lit(0)))
    p = lambda k: F.nullif(F.col("f.properties")[k], F.lit(""))
    box = F.when(F.size("f.bbox") > 0, F.col("f.bbox")).when(F.size("c.bbox") > 0, F.col("c.bbox"))
    return f.select(*[c for c in df.columns if c != json], F.coalesce(F.nullif("f.id", F.lit("")), p("province_code"), p("code")).alias("province_id"), F.coalesce(p("name"), p("province_name"), p("full_name")).alias("province_name"), *[F.get(box, F.lit(k)).alias(n) for k, n in enumerate(("min_lon", "min_lat", "max_lon", "max_lat"))])


def tag_report(df: DataFrame) -> DataFrame:
    """How often each value of each tag column occurs."""
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(t).alias("tag"), F.col(t).alias("value")) for t in TAGS])).alias("p")).select("p.*")
    return pairs.where("value IS NOT NULL").groupBy("tag", "value").agg(F.count(F.lit(1)).alias("n"))
