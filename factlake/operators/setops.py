"""Set comparisons: replay equivalence, contract (key and schema) differences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factlake.session import scratch_dir


def replay_diff(a: DataFrame, b: DataFrame, by: str, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Per ``by`` value: rows in each capture and rows only in one of them.

    Multiset difference both ways (as EXCEPT ALL), ignoring metadata columns
    such as ``fetched_at``, in two aggregations: each distinct row is counted
    in both captures (partial aggregation collapses groups of copies), then
    the surpluses are summed per ``by`` value.
    """
    cols = [c for c in a.columns if c not in ignore]
    u = (a.select(*cols, F.lit(1).alias("_in_a"), F.lit(0).alias("_in_b"))
         .unionByName(b.select(*cols, F.lit(0).alias("_in_a"), F.lit(1).alias("_in_b"))))
    g = u.groupBy(*cols).agg(F.sum("_in_a").alias("_na"), F.sum("_in_b").alias("_nb"))
    per = g.groupBy(by).agg(
        F.sum("_na").alias("rows_a"), F.sum("_nb").alias("rows_b"),
        F.sum(F.greatest(F.col("_na") - F.col("_nb"), F.lit(0))).alias("only_a"),
        F.sum(F.greatest(F.col("_nb") - F.col("_na"), F.lit(0))).alias("only_b"))
    return per.select(by, *[F.col(c).cast("bigint").alias(c) for c in ("rows_a", "rows_b", "only_a", "only_b")],
                      ((F.col("only_a") + F.col("only_b")) == 0).alias("equivalent"))


def replay_tree(a: DataFrame, b: DataFrame, by: str, ignore: tuple[str, ...] = (), buckets: int = 16) -> DataFrame:
    """``replay_diff`` that compares rows only where the captures differ.

    Each capture is summed to a row a (``by``, bucket of rows): its number of rows and the sums of two independent
    64-bit row hashes, which do not depend on order and count copies.  Equal sums mean equal rows (but for a chance
    of 2^-128), so only buckets whose sums differ are compared row by row; the others give their counts."""
    cols = [c for c in a.columns if c not in ignore]

    def leaves(df: DataFrame) -> DataFrame:
        h1, h2 = F.xxhash64(F.lit(1), *cols), F.xxhash64(F.lit(2), *cols)
        return df.select(*cols, h1.alias("_h1"), h2.alias("_h2"), F.pmod(h1, F.lit(buckets)).alias("_leaf"))

    def sums(df: DataFrame, side: str) -> DataFrame:
        return df.groupBy(by, "_leaf").agg(F.count(F.lit(1)).alias(f"_n{side}"),
                                           *[F.sum(F.col(h).cast("decimal(38,0)")).alias(h + side) for h in ("_h1", "_h2")])
    la, lb = leaves(a), leaves(b)
    tree = sums(la, "a").join(sums(lb, "b"), [by, "_leaf"], "full_outer")
    same = F.col("_na").eqNullSafe(F.col("_nb")) & F.col("_h1a").eqNullSafe(F.col("_h1b")) & F.col("_h2a").eqNullSafe(F.col("_h2b"))
    tree = tree.withColumn("_same", same)
    differing = tree.where("NOT _same").select(by, "_leaf")
    left, right = (x.join(differing, [by, "_leaf"], "left_semi").select(*cols) for x in (la, lb))
    rows = replay_diff(left, right, by).select(by, "only_a", "only_b")
    zero = F.lit(0).cast("bigint")
    per = tree.groupBy(by).agg(F.sum(F.coalesce("_na", zero)).alias("rows_a"), F.sum(F.coalesce("_nb", zero)).alias("rows_b"),
                               F.count_if(~F.col("_same")).alias("leaves_compared"))
    out = per.join(rows, by, "left").select(by, "rows_a", "rows_b", F.coalesce("only_a", zero).alias("only_a"), F.coalesce("only_b", zero).alias("only_b"), "leaves_compared")
    return out.select("*", ((F.col("only_a") + F.col("only_b")) == 0).alias("equivalent"))


def key_diff(lines: DataFrame, declared: tuple[str, ...], text_col: str = "value") -> DataFrame:
    """Keys written in JSON lines vs declared fields: how many parseable lines carry
    each key, and whether it is declared, missing from some lines, or undeclared."""
    keyed = lines.select(F.json_object_keys(F.col(text_col)).alias("_k")).where(F.col("_k").isNotNull())
    total = keyed.agg(F.count(F.lit(1))).scalar()
    seen = keyed.select(F.explode("_k").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    decl = seen.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(k) for k in declared])).alias("key"), F.lit(0).cast("bigint").alias("n"))
    g = seen.unionByName(decl).groupBy("key").agg(F.sum("n").alias("lines_with_key"))
    is_decl = F.col("key").isin(*declared)
    return g.select("key", is_decl.alias("declared"), "lines_with_key", total.alias("total_lines"),
                    F.when(~is_decl, F.lit("undeclared"))
                    .when(F.col("lines_with_key") < total, F.lit("missing_in_some"))
                    .otherwise(F.lit("ok")).alias("status"))


def schema_rows(schema: T.StructType) -> list[tuple[str, str, bool]]:
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in schema.fields]


def schema_drift(actual: T.StructType, contract: T.StructType, check_nullable: bool = False) -> list[dict]:
    """Columns whose presence, type (or nullability) differ from the contract."""
    a = {n: (t, nn) for n, t, nn in schema_rows(actual)}
    c = {n: (t, nn) for n, t, nn in schema_rows(contract)}
    out = []
    for n in sorted(set(a) | set(c)):
        if n not in a:
            out.append({"column": n, "issue": "missing", "contract": c[n][0]})
        elif n not in c:
            out.append({"column": n, "issue": "undeclared", "actual": a[n][0]})
        elif a[n][0] != c[n][0]:
            out.append({"column": n, "issue": "type", "actual": a[n][0], "contract": c[n][0]})
        elif check_nullable and a[n][1] and not c[n][1]:
            out.append({"column": n, "issue": "nullable", "actual": True, "contract": False})
    return out


#: Declared simple type -> types a JSON value of it may show.
_JSON_TYPES = {"string": ("STRING",), "date": ("STRING",), "timestamp": ("STRING",), "boolean": ("BOOLEAN",), "int": ("BIGINT",), "bigint": ("BIGINT",),
               "float": ("BIGINT", "DECIMAL", "DOUBLE"), "double": ("BIGINT", "DECIMAL", "DOUBLE"), "struct": ("OBJECT",), "map": ("OBJECT",), "array": ("ARRAY",)}


def declared_paths(schema: T.DataType, path: str = "") -> list[tuple[str, str, tuple[str, ...]]]:
    """(path, declared type, JSON types it may show) of a struct's fields at every depth; ``[]`` are elements."""
    if isinstance(schema, T.StructType):
        inner = [(f"{path}.{f.name}" if path else f.name, f.dataType) for f in schema.fields]
    elif isinstance(schema, T.ArrayType):
        inner = [(path + "[]", schema.elementType)]
    else:
        return []
    out = []
    for name, t in inner:
        kind = "double" if isinstance(t, T.DecimalType) else t.typeName() if isinstance(t, (T.StructType, T.ArrayType, T.MapType)) else t.simpleString()
        out += [(name, t.simpleString(), _JSON_TYPES[kind]), *declared_paths(t, name)]
    return out


def payload_drift(payloads: DataFrame, declared: T.StructType, by: str, text_col: str = "payload_json", depth: int = 3) -> DataFrame:
    """Schema drift of JSON payloads as data: per ``by`` value and path, which types the payloads show, against ``declared``.

    Columns: by, path, declared_type (NULL: undeclared), seen_type (NULL: absent), payloads (how many show it), total (payloads
    of the ``by`` value) and status: ``ok``, ``type``, ``null`` (a JSON null), ``undeclared``, ``absent`` (payloads that can be
    parsed but lack a declared path whose parent they hold; top-level paths have no parent) or ``unparsed`` (path ``$``).
    ``depth`` levels of nesting are walked.  A payload without arrays shows what its schema says, so such payloads are counted
    by schema and only one of each (``by`` value, schema) is walked.  One with an array (its schema merges the elements) is walked
    itself and becomes its distinct (path, type) pairs.  Both are counted with partial aggregation, and the counts written once.
    """
    kind = lambda v: F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)
    node = "array<struct<path:string,value:variant>>"

    def children(path, v):
        name = lambda k: F.when(path == "", k).otherwise(F.concat_ws(".", path, k))
        members = F.transform(F.map_entries(F.try_variant_get(v, "$", "map<string,variant>")), lambda e: F.struct(name(e["key"]).alias("path"), e["value"].alias("value")))
        elements = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda e: F.struct(F.concat(path, F.lit("[]")).alias("path"), e.alias("value")))
        return F.coalesce(members, elements, F.array().cast(node))

    shapes = payloads.select(by, F.col(text_col).alias("_text"), F.schema_of_variant(F.try_parse_json(text_col)).alias("_shape"))
    listed = F.coalesce(F.contains("_shape", F.lit("ARRAY<")), F.lit(False))
    plain = shapes.where(~listed).groupBy(by, "_shape").agg(F.min("_text").alias("_text"), F.count(F.lit(1)).alias("_n"))
    rows = plain.select(by, "_text", "_n").unionByName(shapes.where(listed).select(by, "_text", F.lit(1).cast("bigint").alias("_n")))

    rows = rows.select(by, "_n", F.try_parse_json("_text").alias("_v"))
    rows = rows.select(by, "_n", "_v", children(F.lit(""), F.col("_v")).alias("_l1"))
    for d in range(1, depth):
        rows = rows.withColumn(f"_l{d + 1}", F.flatten(F.transform(f"_l{d}", lambda n: children(n["path"], n["value"]))))
    nodes = F.concat(*[f"_l{d}" for d in range(1, depth + 1)])
    shown = F.array_distinct(F.transform(nodes, lambda n: F.struct(n["path"].alias("path"), kind(n["value"]).alias("seen"))))
    whole = F.array(F.struct(F.lit("$").alias("path"), F.coalesce(kind(F.col("_v")), F.lit("UNPARSED")).alias("seen")))
    seen = rows.select(by, "_n", F.explode(F.concat(whole, shown)).alias("n")).groupBy(by, "n.path", "n.seen").agg(F.sum("_n").alias("payloads"))
    path = scratch_dir(payloads.sparkSession, "drift-seen")  # read by five branches below
    seen.write.parquet(path)
    seen = payloads.sparkSession.read.schema(seen.schema).parquet(path)

    top = seen.where("path = '$'").groupBy(by).agg(F.sum("payloads").alias("total"))
    unparsed = seen.where("path = '$' AND seen <> 'OBJECT'").select(by, "path", "seen", "payloads", F.lit(None).cast("string").alias("declared_type"), F.lit("unparsed").alias("status"))
    fixed = declared_paths(declared)
    types = {p: t for p, t, _ in fixed}
    literal = F.create_map(*[F.lit(x) for p, t in types.items() for x in (p, t)])
    fits = F.lit(False)
    for p, _, ok in fixed:
        fits = fits | ((F.col("path") == p) & F.col("seen").isin(*ok))
    found = seen.where("path <> '$'").withColumn("declared_type", literal[F.col("path")]).withColumn(
        "status", F.when(F.col("declared_type").isNull(), "undeclared").when(F.col("seen") == "VOID", "null").when(fits, "ok").otherwise("type"))
    # declared paths that some payloads lack: counted against the payloads that hold the parent
    held = seen.where("path <> '$' AND path NOT LIKE '%[]'").groupBy(by, "path").agg(F.sum("payloads").alias("have"))
    parents = seen.where("seen = 'OBJECT'").groupBy(by, "path").agg(F.sum("payloads").alias("hold")).toDF(by, "parent", "hold")
    want = F.array(*[F.struct(F.lit(p).alias("path"), F.lit(p.rpartition(".")[0] or "$").alias("parent"), F.lit(t).alias("declared_type"))
                     for p, t, _ in fixed if not p.endswith("[]") and not p.rpartition(".")[0].endswith("[]")])
    due = top.select(by, F.inline(want)).join(parents, [by, "parent"]).join(held, [by, "path"], "left")
    lacking = due.withColumn("payloads", F.col("hold") - F.coalesce("have", F.lit(0))).where("payloads > 0").select(
        by, "path", F.lit(None).cast("string").alias("seen"), "payloads", "declared_type", F.lit("absent").alias("status"))
    return found.unionByName(unparsed).unionByName(lacking).join(top, by).select(
        by, "path", "declared_type", F.col("seen").alias("seen_type"), "payloads", "total", "status")
