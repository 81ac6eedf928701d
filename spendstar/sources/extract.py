"""The published extract: one JSON document with totals, channel and monthly marts.

The document is written in lines: an opening line that holds the totals, a line per
channel, a line between the two lists, a line per month, a closing line; each entry but a
list's first begins with a comma. So it can be written and read in parallel:

* ``write_extract`` writes the sorted lines as part files, from the executors, into a
  folder of their own. The commit is a small manifest beside them that names the parts in
  order and replaces the manifest before it, so readers see the old document or the new
  one, whole. ``single_file`` gives one plain file instead: parts are concatenated by the
  file system where it can, else one task writes the sorted lines. No byte of
  the document passes the driver.
* ``read_extract`` follows the manifest (or reads a plain file), tells the lines apart, and
  checks the order of the frame, every entry and every comma with one aggregate over all
  lines; channels and months come back as tables.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendstar.schemas import CHANNEL_ROW_SCHEMA, MARTS_SCHEMA, MONTHLY_ROW_SCHEMA
from spendstar.sources.files import Files

JSON_OPTIONS = {"ignoreNullFields": "false"}
MANIFEST = "manifest.json"
# A plain file in another layout (indented by another tool) is parsed as one value up to this size.
PLAIN_LIMIT = 16 << 20

# --- fixed values (the lines of the frame) ---
TO_CHANNELS = ', "channels":['
TO_MONTHS = '], "monthly":['
CLOSING = "]}"
# ---------------------------------------------


class ExtractError(ValueError):
    """The extract does not have the required shape."""


# -- writing -----------------------------------------------------------------------
def _entry_lines(part: int, rows: DataFrame, keys: list[str]) -> DataFrame:
    """A line per row; all but the one of the smallest keys start with a comma."""
    key = F.struct(*keys)
    smallest = rows.agg(F.min(key).alias("k")).scalar()
    comma = F.when(key == smallest, "").otherwise(",")
    line = F.concat(comma, F.to_json(F.struct(*rows.columns), JSON_OPTIONS))
    return rows.select(F.lit(part).alias("part"), F.array(*keys).alias("key"), line.alias("line"))


def document_lines(
    totals: DataFrame, channels: DataFrame, monthly: DataFrame, generated_at: str, seed: int
) -> DataFrame:
    """(part, key, line): the document's lines, to be sorted by part and key."""
    opening = json.dumps({"generated_at": generated_at, "seed": int(seed)})[:-1] + ', "totals":'
    frame = [
        (0, F.concat(F.lit(opening), F.to_json(F.struct(*totals.columns), JSON_OPTIONS), F.lit(TO_CHANNELS))),
        (2, F.lit(TO_MONTHS)),
        (4, F.lit(CLOSING)),
    ]
    none = F.array().cast("array<string>")
    structs = [F.struct(F.lit(p).alias("part"), none.alias("key"), line.alias("line")) for p, line in frame]
    return (
        totals.select(F.inline(F.array(*structs)))
        .unionByName(_entry_lines(1, channels, ["channel_group", "channel_name"]))
        .unionByName(_entry_lines(3, monthly, ["year_month"]))
    )


def _parts(files: Files, folder: str) -> list[tuple[str, int]]:
    """(name, bytes) of a folder's part files, in order."""
    found = [(name, size) for name, size in files.sizes(folder) if name.startswith("part-") and size]
    return sorted(found, key=lambda part: int(part[0].split("-")[1]))


def write_extract(spark: SparkSession, lines: DataFrame, uri: str, single_file: bool = False) -> str:
    """Write the lines to ``uri``, a folder with a manifest or one plain file; return it.

    Parent folders are created. A write that fails leaves the document that was there.
    """
    files, uri = Files(spark), uri.rstrip("/")
    version = uuid.uuid4().hex
    if single_file:
        folder = f"{uri}.parts-{version}"
        try:
            _write_file(files, lines, folder, uri)
        finally:
            files.remove(folder)
        return uri
    folder = f"{uri}/{version}"
    before = read_manifest(files, uri)
    try:
        lines.orderBy("part", "key").select("line").write.text(folder)
        manifest = {"version": version, "parts": [{"file": n, "bytes": b} for n, b in _parts(files, folder)]}
        files.replace(f"{uri}/{MANIFEST}", json.dumps(manifest))
    except BaseException:
        files.remove(folder)
        raise
    # the version before stays for readers that have its manifest; older ones go
    kept = {version, MANIFEST} | ({before["version"]} if before else set())
    for name in files.names(uri):
        if name not in kept and not name.startswith((".", "_")):
            files.remove(f"{uri}/{name}")
    return uri


def _write_file(files: Files, lines: DataFrame, folder: str, uri: str) -> None:
    lines.orderBy("part", "key").select("line").write.text(folder)
    parts = [f"{folder}/{name}" for name, _ in _parts(files, folder)]
    if len(parts) > 1 and not files.concat(parts):
        # one sorted task: a file system without concatenation takes a file from one writer only
        files.remove(folder)
        lines.repartition(1).sortWithinPartitions("part", "key").select("line").write.text(folder)
        parts = [f"{folder}/{name}" for name, _ in _parts(files, folder)]
    files.move_over(parts[0], uri)


# -- reading -----------------------------------------------------------------------
@dataclass
class Extract:
    """A validated extract; ``totals`` is its one row of totals."""

    generated_at: str
    seed: int
    totals: DataFrame
    channels: DataFrame
    monthly: DataFrame

    def flattened(self) -> DataFrame:
        """All rows: one of the totals, one per channel, one per month."""
        parts = [
            rows.select(
                F.lit(section).alias("section"),
                F.lit(self.generated_at).alias("generated_at"),
                F.lit(self.seed).cast("long").alias("seed"),
                *rows.columns,
            )
            for section, rows in (("totals", self.totals), ("channels", self.channels), ("monthly", self.monthly))
        ]
        return parts[0].unionByName(parts[1], True).unionByName(parts[2], True)


def read_manifest(files: Files, uri: str) -> dict | None:
    """The manifest of an extract written in parts, None if there is none."""
    place = f"{uri}/{MANIFEST}"
    return json.loads(files.read_small(place)) if files.exists(place) else None


def _document_files(files: Files, uri: str) -> list[str]:
    manifest = read_manifest(files, uri)
    if manifest is None:
        return [uri]
    folder = f"{uri}/{manifest['version']}"
    found = dict(files.sizes(folder)) if files.exists(folder) else {}
    wrong = [p["file"] for p in manifest["parts"] if found.get(p["file"]) != p["bytes"]]
    if wrong:
        raise ExtractError(f"extract {uri} lacks parts, or they differ from its manifest: {wrong[:5]}")
    return [f"{folder}/{p['file']}" for p in manifest["parts"]]


def _parsed(text: Column, schema: T.StructType) -> Column:
    """``text`` as a struct of the schema; NULL if it is no such object."""
    strict = T.StructType([*schema.fields, T.StructField("_rest", T.StringType())])
    found = F.from_json(text, strict, {"columnNameOfCorruptRecord": "_rest"})
    return F.when(found["_rest"].isNull(), found)


_HEAD_SCHEMA = T.StructType([f for f in MARTS_SCHEMA.fields if f.name not in ("channels", "monthly")])


def _number(head: Column) -> Column:
    """Whether the total spend is a number (not its text)."""
    return F.get_json_object(head, "$.totals").rlike(r'"spend_dkk"\s*:\s*-?[0-9]')


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Every line with its place in the document, its kind and its entry."""
    part = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1)
    # rows of one split keep their order, and splits of one file start at rising bytes
    place = F.struct(
        F.when(part == "", 0).otherwise(part.try_cast("int")).alias("part"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
    )
    text = F.btrim("value", F.lit(" \t\r"))
    rows = spark.read.text(paths).select(place.alias("place"), text.alias("text")).where("text <> ''")
    entry = F.regexp_replace("text", r"^,\s*", "")
    # which list an entry is for shows in its keys
    keys = F.json_object_keys(entry)
    kind = (
        F.when(F.col("text") == TO_MONTHS, "middle")
        .when(F.col("text") == CLOSING, "closing")
        .when(F.endswith("text", F.lit(TO_CHANNELS)), "opening")
        .when(F.array_contains(keys, "channel_name"), "channel")
        .when(F.array_contains(keys, "year_month"), "month")
    )
    return rows.select("place", "text", entry.alias("entry"), F.coalesce(kind, F.lit("other")).alias("kind"))


def _structure(lines: DataFrame) -> Row:
    """Counts and first and last places of each kind of line, and the document's head: one row."""
    kind, place = F.col("kind"), F.col("place")
    head = F.concat(F.expr(f"left(text, length(text) - {len(TO_CHANNELS)})"), F.lit("}"))
    schemas = {"channel": CHANNEL_ROW_SCHEMA, "month": MONTHLY_ROW_SCHEMA}
    wrong = kind == "other"
    for name, schema in schemas.items():
        wrong |= (kind == name) & _parsed(F.col("entry"), schema).isNull()
    measures = [
        F.count_if(wrong).alias("wrong"),
        F.min("place").alias("first"),
        F.max("place").alias("last"),
        F.max(F.when(kind == "opening", head)).alias("head"),
    ]
    for name in ("opening", "middle", "closing", *schemas):
        of = kind == name
        measures += [F.count_if(of).alias(name), F.min(F.when(of, place)).alias(f"first_{name}")]
        measures.append(F.max(F.when(of, place)).alias(f"last_{name}"))
    for name in schemas:
        bare = (kind == name) & ~F.startswith("text", F.lit(","))
        measures += [F.count_if(bare).alias(f"bare_{name}"), F.min(F.when(bare, place)).alias(f"first_bare_{name}")]
    out = lines.agg(*measures)
    parsed = _parsed(F.col("head"), _HEAD_SCHEMA)
    return out.select("*", F.when(_number(F.col("head")), parsed).alias("parsed")).first()


def _faults(s: Row) -> list[str]:
    """What is wrong with a document of these counts and places."""
    if s["wrong"] or not s["opening"] == s["middle"] == s["closing"] == 1:
        return [f"{s['wrong']} lines are no entries; {s['opening']} openings, {s['middle']} middles, {s['closing']} ends"]
    out = []
    if s["first"] != s["first_opening"] or s["last"] != s["last_closing"]:
        out.append("lines outside the document")
    if s["parsed"] is None or s["parsed"]["totals"] is None or s["parsed"]["totals"]["spend_dkk"] is None:
        out.append("no numeric totals.spend_dkk")
    for name, after, before in (("channel", "opening", "middle"), ("month", "middle", "closing")):
        if s[name] and not s[f"last_{after}"] < s[f"first_{name}"] <= s[f"last_{name}"] < s[f"first_{before}"]:
            out.append(f"{name} entries outside their list")
        if s[f"bare_{name}"] != min(1, s[name]) or s[f"first_bare_{name}"] != s[f"first_{name}"]:
            out.append(f"commas between {name} entries")
    return out


def _is_framed(spark: SparkSession, files: Files, path: str) -> bool:
    """Whether a plain file has this module's layout; a small one is looked at, a large one must have it."""
    if files.size(path) > PLAIN_LIMIT:
        return True
    rows = spark.read.text(path).where(F.btrim("value", F.lit(" \t\r")) != "").take(2)
    return len(rows) == 2 and rows[0]["value"].strip().endswith(TO_CHANNELS)


def _read_whole(spark: SparkSession, path: str) -> Extract:
    """A small document in any layout, parsed as one value."""
    whole = spark.read.text(path, wholetext=True).select(F.btrim("value", F.lit(" \t\r\n")).alias("text"))
    fitting = F.startswith("text", F.lit("{")) & F.endswith("text", F.lit("}")) & _number(F.col("text"))
    # in brackets, a second document is an error or a second element
    listed = F.from_json(F.concat(F.lit("["), "text", F.lit("]")), T.ArrayType(MARTS_SCHEMA))
    parsed = whole.select(F.when(fitting & (F.size(listed) == 1), F.try_element_at(listed, F.lit(1))).alias("doc"))
    complete = F.col("doc.totals.spend_dkk").isNotNull() & F.col("doc.channels").isNotNull() & F.col("doc.monthly").isNotNull()
    found = parsed.select(F.when(complete, F.struct("doc.generated_at", "doc.seed")).alias("about")).collect()
    if len(found) != 1 or found[0]["about"] is None:
        raise ExtractError(f"invalid extract at {path}: not one object with totals, channels and monthly")
    return Extract(
        *found[0]["about"],
        parsed.select("doc.totals.*"),
        parsed.select(F.inline("doc.channels")),
        parsed.select(F.inline("doc.monthly")),
    )


def read_extract(spark: SparkSession, uri: str) -> Extract:
    """Read and validate an extract: numeric ``totals.spend_dkk``, both lists present and well formed.

    Raises ``ExtractError`` when the document lacks that shape.
    """
    files, uri = Files(spark), uri.rstrip("/")
    paths = _document_files(files, uri)
    if paths == [uri] and not _is_framed(spark, files, uri):
        return _read_whole(spark, uri)
    lines = _lines(spark, paths)
    structure = _structure(lines)
    faults = _faults(structure)
    if faults:
        raise ExtractError(f"invalid extract at {uri}: {'; '.join(faults)}")
    head = structure["parsed"]
    totals = spark.createDataFrame([tuple(head["totals"])], _HEAD_SCHEMA["totals"].dataType)

    def entries(kind: str, schema: T.StructType) -> DataFrame:
        parsed = _parsed(F.col("entry"), schema)
        return lines.where(F.col("kind") == kind).select(parsed.alias("entry")).select(*[f"entry.{f}" for f in schema.names])

    return Extract(
        head["generated_at"],
        head["seed"],
        totals,
        entries("channel", CHANNEL_ROW_SCHEMA),
        entries("month", MONTHLY_ROW_SCHEMA),
    )
