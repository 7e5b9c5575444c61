"""Nested JSON walked a level at a time, as VARIANT values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.functions import url
from quarrymill.operators.lineage import Scratch

#: Levels and values of a document beyond which it is set aside.
MOST_DEPTH, MOST_NODES = 32, 100_000
#: Levels that are walked in one pass.
LEVELS = 4

# Keys of JSON-LD whose values are media, by kind.
MEDIA_KEYS = {
    "image": ("image", "thumbnail", "thumbnailurl", "primaryimageofpage"),
    "document": ("transcript", "caption", "captions", "subtitle", "subtitles"),
    "video": ("video", "videourl", "embedurl", "trailer"),
    "audio": ("audio", "audioobject", "audiourl", "associatedmedia"),
}
INHERITED_KEYS = ("contenturl", "embedurl", "encoding", "isbasedon")
ADDRESS_KEYS = ("contentUrl", "contenturl", "embedUrl", "embedurl", "thumbnailUrl", "thumbnailurl", "url", "@id")


def shape_of(value: Column) -> Column:
    """OBJECT, ARRAY, or the type of a single value. ``schema_of_variant`` of objects and arrays would walk all that is inside, once at each level."""
    shape = F.when(F.try_variant_get(value, "$", "struct<_:boolean>").isNotNull(), "OBJECT").when(F.try_variant_get(value, "$", "array<struct<_:boolean>>").isNotNull(), "ARRAY")
    return shape.otherwise(F.schema_of_variant(value))


def kind_of(shape: Column) -> Column:
    """object, array, string, number, boolean or null."""
    return F.when(shape.isNull() | (shape == "VOID"), "null").when(shape.isin("OBJECT", "ARRAY", "STRING", "BOOLEAN"), F.lower(shape)).otherwise("number")


def children(rows: DataFrame, value: str, *kept: str) -> DataFrame:
    """Members of objects and arrays: kept columns, pos, key (null in an array) and child."""
    rows.createOrReplaceTempView("_quarrymill_walk")
    spark = rows.sparkSession
    out = spark.sql(f"SELECT {', '.join(f'w.`{c}`' for c in kept)}, e.pos, e.key, e.value AS child FROM _quarrymill_walk w, LATERAL variant_explode(w.`{value}`) e")
    spark.catalog.dropTempView("_quarrymill_walk")
    return out


def scalar(value: Column, kind: Column) -> Column:
    """A string, number or boolean as text."""
    return F.when(kind.isin("string", "number", "boolean"), F.try_variant_get(value, "$", "string"))


def unfolded(rows: DataFrame) -> DataFrame:
    """Rows id, path, kind, value, inner, nodes with each object and array replaced by its members; all other rows stay.

    ``inner`` is the object or array, else null, so that a leaf's row is carried on without any; ``nodes`` counts the row and those that were
    replaced by rows of which it is the first. An empty object or array becomes a leaf.
    """
    rows.createOrReplaceTempView("_quarrymill_walk")
    spark = rows.sparkSession
    out = spark.sql("SELECT w.id, w.path, w.kind, w.value, w.nodes, e.pos, e.key, e.value AS child FROM _quarrymill_walk w, LATERAL variant_explode_outer(w.inner) e")
    spark.catalog.dropTempView("_quarrymill_walk")
    member, child = F.col("pos").isNotNull(), F.col("child")
    step = F.when(F.col("kind") == "array", F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]"))).otherwise(F.concat(F.lit("."), F.col("key")))
    path = F.when(member, F.concat("path", step)).otherwise(F.col("path"))
    nodes = F.when(F.col("pos") > 0, F.lit(1)).when(member, F.col("nodes") + 1).otherwise(F.col("nodes"))
    out = out.withColumn("shape", shape_of(child))
    out = out.select("id", path.alias("path"), F.when(member, kind_of(F.col("shape"))).otherwise(F.col("kind")).alias("kind"), F.when(~member, F.col("value")).alias("value"), "child", nodes.alias("nodes"))
    return out.select("id", "path", "kind", F.coalesce("value", scalar(child, F.col("kind"))).alias("value"), F.when(F.col("kind").isin("object", "array"), child).alias("inner"), "nodes")


def walk(docs: DataFrame, ident: str, json: str, most_depth: int = MOST_DEPTH, most_nodes: int = MOST_NODES) -> tuple[DataFrame, DataFrame]:
    """Leaves (ident, path, kind, value), and what is set aside (ident, reason).

    A document is set aside whole if it is no JSON (malformed), has values below ``most_depth`` levels (too_deep), or more than ``most_nodes``
    values (too_many). Null documents count as malformed. A round takes LEVELS levels in one pass, without a shuffle, and writes the leaves once, beside the
    objects and arrays of its last level, which alone the next round reads; rounds end with the deepest document or the limit. Empty objects and
    arrays are leaves of their kind without a value. Rows of one ident count as one document's.
    """
    scratch = Scratch(docs.sparkSession)
    parsed = docs.select(docs[f"`{ident}`"].alias("id"), F.try_parse_json(docs[f"`{json}`"]).alias("v"))
    v, kind = F.col("v"), F.col("kind")
    rows = parsed.withColumn("shape", shape_of(v)).select("id", F.lit("$").alias("path"), F.when(v.isNull(), "malformed").otherwise(kind_of(F.col("shape"))).alias("kind"), "v")
    rows = rows.select("id", "path", "kind", scalar(v, kind).alias("value"), F.when(kind.isin("object", "array"), v).alias("inner"), F.lit(1).alias("nodes"))
    every, taken = None, 0
    while True:
        step = min(LEVELS, most_depth - taken)
        for _ in range(step):
            rows = unfolded(rows)
        taken += step
        held = scratch.keep(rows)
        open_ = held.where("inner is not null")
        last = taken >= most_depth or open_.isEmpty()
        done = held if last else held.where("inner is null")
        every = done if every is None else every.unionAll(done)
        if last:
            break
        rows = open_
    deep = children(open_, "inner", "id").select("id").distinct().withColumn("reason", F.lit("too_deep"))
    many = every.groupBy("id").agg(F.sum("nodes").alias("n")).where(F.col("n") > most_nodes).select("id", F.lit("too_many").alias("reason"))
    bad = every.where("kind = 'malformed'").select("id", F.lit("malformed").alias("reason"))
    aside = scratch.keep(bad.unionAll(deep).unionAll(many).groupBy("id").agg(F.min("reason").alias("reason")))
    leaves = every.where(kind != "malformed").join(aside.select(F.col("id").alias("_id")), F.col("id").eqNullSafe(F.col("_id")), "left_anti")
    return leaves.select(F.col("id").alias(ident), "path", "kind", "value"), aside.withColumnRenamed("id", ident)


def type_kind(kind: Column) -> Column:
    """image, video or audio, by what a type ends with."""
    t = F.lower(F.trim(kind))
    return F.when(F.endswith(t, F.lit("imageobject")) | (t == "image"), "image").when(F.endswith(t, F.lit("videoobject")) | (t == "video"), "video").when(F.endswith(t, F.lit("audioobject")) | (t == "audio") | F.endswith(t, F.lit("/audio")), "audio")


def key_kind(key: Column, inherited: Column) -> Column:
    k = F.lower(F.trim(key))
    out = F.when(k.isin(*INHERITED_KEYS) & inherited.isNotNull(), inherited)
    for kind, names in MEDIA_KEYS.items():
        out = out.when(k.isin(*names), kind)
    return out


def media_objects(docs: DataFrame, ident: str, json: str, most_depth: int = MOST_DEPTH) -> DataFrame:
    """Media that JSON-LD names: ident, path, address, kind, name, description.

    A value under a media key is an address, or an object that has one; its kind is that of the address's suffix, else of the key. An
    object of a media type hands its kind down, and with it its name and description, until another object inside has its own. Values below
    ``most_depth`` levels aren't reached; documents that are null or no JSON give no rows.
    """
    scratch = Scratch(docs.sparkSession)
    string = lambda v, path: F.trim(F.coalesce(F.try_variant_get(v, path, "string"), F.lit("")))
    none = F.lit(None).cast("string")
    level = docs.select(docs[f"`{ident}`"].alias("id"), F.lit("$").alias("path"), F.try_parse_json(docs[f"`{json}`"]).alias("value"), none.alias("kind"), none.alias("under"), none.alias("name"), none.alias("description")).where("value is not null")
    out = None
    for _ in range(most_depth + 1):
        v = F.col("value")
        level = level.withColumn("shape", shape_of(v)).withColumn("shape", kind_of(F.col("shape")))
        types = F.concat(F.array(F.try_variant_get(v, "$['@type']", "string")), F.coalesce(F.try_variant_get(v, "$['@type']", "array<string>"), F.array().cast("array<string>")))
        own = F.when(F.col("shape") == "object", F.get(F.filter(F.transform(types, type_kind), lambda x: x.isNotNull()), F.lit(0)))
        address = F.coalesce(*[F.when(string(v, f"$['{k}']") != "", string(v, f"$['{k}']")) for k in ADDRESS_KEYS])
        address = F.when(F.col("shape") == "string", F.when(string(v, "$") != "", string(v, "$"))).when(F.col("shape") == "object", address)
        level = scratch.keep(level.withColumn("own", own).withColumn("address", F.when(F.col("under").isNotNull(), address)))
        found = level.where("address is not null")
        out = found if out is None else out.unionAll(found)
        kind = F.coalesce("own", "kind")
        media = (F.col("shape") == "object") & kind.isin("image", "audio", "video")
        said = lambda path, before: F.when(media & (string(v, path) != ""), string(v, path)).otherwise(before)
        inner = level.where("shape in ('object', 'array')").select("id", "path", "value", "shape", "under", kind.alias("kind"), said("$.name", F.col("name")).alias("name"), said("$.description", F.col("description")).alias("description"))
        below = children(inner, "value", "id", "path", "shape", "under", "kind", "name", "description")
        here = F.when(F.col("shape") == "array", F.col("under")).otherwise(key_kind(F.col("key"), F.col("kind")))
        step = F.when(F.col("shape") == "array", F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]"))).otherwise(F.concat(F.lit("."), F.col("key")))
        level = below.select("id", F.concat("path", step).alias("path"), F.col("child").alias("value"), F.coalesce(here, F.col("kind")).alias("kind"), here.alias("under"), "name", "description")
        if level.isEmpty():
            break
    suffix = url.kind(F.col("address"))
    return out.select(F.col("id").alias(ident), "path", "address", F.when(suffix.isNotNull() & (suffix != "page"), suffix).otherwise(F.col("under")).alias("kind"), "name", "description")
