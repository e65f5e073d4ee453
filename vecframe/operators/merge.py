"""Deep merge of nested JSON documents by key (D1-D3), as a plan over paths.

The two tables meet once, in a full outer join on the key.  A pair of documents
is then merged in its row, by an expression that goes down the maps that both
share: a node where both sides are maps is put together from its keys, and every
other node is a leaf with a result of its own:

* both lists: the patch items that are not in the *original* base list are
  appended (duplicates inside either list stay);
* else the patch value, an explicit ``null`` included; without one, the base's.

The expression goes ``INLINE_DEPTH`` shared maps deep.  Pairs that share more are
marked by it, and merged as a plan over paths: a node is a path of one document
pair with both sides' values, exploded into its keys (one pass per nesting level
that the pair shares), and the results are put together again from the deepest
level up, grouped by their parent path.  All of it is Spark SQL on VARIANT
values; nothing is parsed in Python.

At the root, a patch that is not a map leaves the base unchanged; a key with
no base takes the patch document.  Keys keep the base's order, new keys follow
in the patch's.  Numbers keep their value exactly (up to 38 digits; beyond that a
decimal is a double).  List items are equal if type and canonical text (sorted
keys) are, so ``1`` and ``1.0`` differ and so do ``true`` and ``1``.  Duplicate
keys in a document, and more than one document for a key and side, are errors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecframe.session import scratch_path

SIDES = ("b", "p")


def _one_each(df: DataFrame, key: str, doc: str, side: str, check: bool) -> DataFrame:
    """``(_k, text)``, one row a key, dealt out by key: the aggregate and the join share that partitioning.

    The number of tasks is given, for merging costs more than the documents' bytes say."""
    rows = df.select(F.col(key).alias("_k"), F.col(doc).alias(side)).repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_k")
    if not check:
        return rows
    found = rows.groupBy("_k").agg(F.count(F.lit(1)).alias("_n"), F.first(side).alias(side))
    message = F.concat(F.lit(f"{'base' if side == 'b' else 'patch'} has more than one document for key "), F.coalesce(F.col("_k").cast("string"), F.lit("NULL")))
    return found.select("_k", F.when(F.col("_n") > 1, F.raise_error(message).cast("string")).otherwise(F.col(side)).alias(side))


def _is(j: str, opening: str) -> Column:
    return F.coalesce(F.col(j).startswith(opening), F.lit(False))


def _text(side: str) -> Column:
    """A side's text: as written where that reads back to the exact value, else canonical."""
    raw, exact = F.col(f"{side}r"), F.col(f"{side}j")
    return F.when(F.to_json(F.try_parse_json(raw)) == exact, raw).otherwise(exact)


def _items(side: str) -> str:
    return f"transform(cast(parse_json({side}t) as array<variant>), x -> struct(schema_of_variant(x) as kind, to_json(x) as j))"


def _union() -> Column:
    """D2 on two list nodes, as text."""
    fresh = F.expr(f"filter({_items('p')}, x -> NOT array_contains({_items('b')}, x))")
    added = F.array_join(F.transform(fresh, lambda x: x.j), ",")
    comma = F.when(F.expr("size(cast(parse_json(bt) as array<variant>)) = 0"), "").otherwise(",")
    return F.when(F.size(fresh) == 0, F.col("bt")).otherwise(F.concat(F.regexp_replace("bt", r"\s*\]\s*$", ""), comma, added, F.lit("]")))


def _children(maps: DataFrame) -> DataFrame:
    """The nodes below nodes whose sides are both maps, in the order of their keys."""
    both = maps
    for s in SIDES:
        both = (both.withColumn(f"{s}x", F.expr(f"transform_values(cast(parse_json({s}j) as map<string, variant>), (k, v) -> to_json(v))"))
                .withColumn(f"{s}m", F.from_json(f"{s}r", "map<string,string>")).withColumn(f"{s}k", F.expr(f"json_object_keys({s}r)")))
    keys = F.concat("bk", F.filter("pk", lambda x: ~F.array_contains("bk", x)))
    rows = both.select("_k", "path", "bx", "bm", "px", "pm", F.posexplode(keys).alias("ord", "name"))
    out = ["_k", F.concat("path", F.array("name")).alias("path"), "ord", "name"]
    for s in SIDES:
        j = F.col(f"{s}x")[F.col("name")]
        # strings come unquoted from the map of texts: their exact text is quoted
        out += [j.alias(f"{s}j"), F.when(j.startswith('"'), j).otherwise(F.coalesce(F.col(f"{s}m")[F.col("name")], j)).alias(f"{s}r")]
    return rows.select(*out)


def _kept(df: DataFrame, place: str) -> DataFrame:
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


# Shared maps, one inside the other, that the expression of a row merges.
INLINE_DEPTH = 3
# What stands for a node that lies deeper: no JSON text has it.
DEEPER = "\x00"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.transform(F.array(value), body)[0]


def _written(raw: Column, exact: Column) -> Column:
    return F.when(raw == exact, raw).when(F.to_json(F.try_parse_json(raw)) == exact, raw).otherwise(exact)


def _list_items(text: Column) -> Column:
    return F.transform(F.parse_json(text).cast("array<variant>"), lambda x: F.struct(F.schema_of_variant(x).alias("kind"), F.to_json(x).alias("j")))


def _joined_lists(base: Column, patch: Column) -> Column:
    """:func:`_union` of two texts."""
    def added(items):
        fresh = F.filter(items["p"], lambda x: ~F.array_contains(items["b"], x))
        comma = F.when(F.size(items["b"]) == 0, "").otherwise(",")
        return F.when(F.size(fresh) == 0, base).otherwise(
            F.concat(F.regexp_replace(base, r"\s*\]\s*$", ""), comma, F.array_join(F.transform(fresh, lambda x: x["j"]), ","), F.lit("]")))

    return _let(F.struct(_list_items(base).alias("b"), _list_items(patch).alias("p")), added)


def _opens(text: Column, sign: str) -> Column:
    return F.coalesce(text.startswith(sign), F.lit(False))


def _sides(bj: Column, br: Column, pj: Column, pr: Column) -> Column:
    return F.struct(bj.alias("bj"), br.alias("br"), pj.alias("pj"), pr.alias("pr"))


def _merged(n: Column, depth: int, root: bool = False) -> Column:
    """The text of a node from its sides' canonical (``j``) and own (``r``) texts."""
    bt, pt = _written(n["br"], n["bj"]), _written(n["pr"], n["pj"])
    if root:
        leaf = F.when(n["bj"].isNotNull(), bt).otherwise(pt)
    else:
        lists = _opens(n["bj"], "[") & _opens(n["pj"], "[")
        leaf = (F.when(n["pj"].isNull(), bt).when(n["bj"].isNull(), pt)
                .when(lists, _let(F.struct(bt.alias("b"), pt.alias("p")), lambda t: _joined_lists(t["b"], t["p"]))).otherwise(pt))
    both = _opens(n["bj"], "{") & _opens(n["pj"], "{")
    if depth == 0:
        return F.when(both, F.lit(DEEPER)).otherwise(leaf)
    open_map = []
    for s in SIDES:
        exact = F.transform_values(F.parse_json(n[f"{s}j"]).cast("map<string,variant>"), lambda _, v: F.to_json(v))
        # the texts as written are looked at only where they differ from the canonical ones
        own = F.when(n[f"{s}r"] != n[f"{s}j"], F.from_json(n[f"{s}r"], "map<string,string>"))
        open_map += [exact.alias(f"{s}x"), own.alias(f"{s}m"), F.json_object_keys(n[f"{s}r"]).alias(f"{s}k")]

    def entry(m, name):
        values = []
        for s in SIDES:
            j = m[f"{s}x"][name]
            values += [j, F.when(j.startswith('"'), j).otherwise(F.coalesce(m[f"{s}m"][name], j))]
        quoted = F.to_json(F.array(name))
        return F.concat(F.substring(quoted, F.lit(2), F.length(quoted) - 2), F.lit(":"), _let(_sides(*values), lambda child: _merged(child, depth - 1)))

    def whole(m):
        keys = F.concat(m["bk"], F.filter(m["pk"], lambda x: ~F.array_contains(m["bk"], x)))
        return F.concat(F.lit("{"), F.array_join(F.transform(keys, lambda name: entry(m, name)), ","), F.lit("}"))

    return F.when(both, _let(F.struct(*open_map), whole)).otherwise(leaf)


def merge_tables(base: DataFrame, patch: DataFrame, key: str = "key", doc: str = "doc",
                 check_unique: bool = True, inline_depth: int = INLINE_DEPTH) -> DataFrame:
    """``(key, doc)`` for every key of either table.

    The merged rows are written once to the shared folder; pairs that share more than ``inline_depth`` maps, one inside
    the other, are then merged level by level."""
    place = scratch_path(base.sparkSession, "merge")
    met = _one_each(base, key, doc, "b", check_unique).join(_one_each(patch, key, doc, "p", check_unique), "_k", "full_outer")
    sides = _sides(F.to_json(F.parse_json("b")), F.col("b"), F.to_json(F.parse_json("p")), F.col("p"))
    done = _kept(met.select(F.col("_k").alias(key), _let(sides, lambda n: _merged(n, inline_depth, root=True)).alias(doc), "b", "p")
                 .withColumn("deeper", F.coalesce(F.contains(doc, F.lit(DEEPER)), F.lit(False)))
                 .withColumns({s: F.when(F.col("deeper"), F.col(s)) for s in SIDES}), f"{place}/done")
    out = done.where(~F.col("deeper")).select(key, doc)
    deep = done.where("deeper")
    if deep.isEmpty():
        return out
    return out.unionByName(_merge_levels(deep.select(F.col(key).alias("_k"), "b", "p"), place, key, doc))


def _merge_levels(met: DataFrame, place: str, key: str, doc: str) -> DataFrame:
    """Pairs ``(_k, b, p)`` merged over paths.

    Each level is written to the shared folder: it is read twice, for the next level and for the way up."""
    nodes = met.select("_k", F.array().cast("array<string>").alias("path"), F.lit(0).alias("ord"), F.lit("").alias("name"),
                       F.to_json(F.parse_json("b")).alias("bj"), F.col("b").alias("br"), F.to_json(F.parse_json("p")).alias("pj"), F.col("p").alias("pr"))
    levels = []
    shared = _is("bj", "{") & _is("pj", "{")
    while True:
        nodes = _kept(nodes, f"{place}/level-{len(levels)}")
        levels.append(nodes)
        if nodes.where(shared).isEmpty():
            break
        nodes = _children(nodes.where(shared))
    below = None
    for depth in range(len(levels) - 1, -1, -1):
        nodes = levels[depth].withColumns({"bt": _text("b"), "pt": _text("p")})
        if depth:
            own = (F.when(F.col("pj").isNull(), F.col("bt")).when(F.col("bj").isNull(), F.col("pt"))
                   .when(_is("bj", "[") & _is("pj", "["), _union()).otherwise(F.col("pt")))
        else:
            own = F.when(F.col("bj").isNotNull(), F.col("bt")).otherwise(F.col("pt"))
        done = nodes.where(~shared).select("_k", "path", "ord", "name", own.alias("text"))
        if below is not None:
            # a name is quoted as the one item of a list
            entry = F.struct("ord", F.concat(F.expr("regexp_extract(to_json(array(name)), '^.(.*).$', 1)"), F.lit(":"), F.col("text")).alias("e"))
            parts = below.groupBy("_k", F.slice("path", 1, depth).alias("path")).agg(F.array_sort(F.collect_list(entry)).alias("parts"))
            parts = parts.select(F.col("_k").alias("_pk"), F.col("path").alias("_pp"), F.concat(
                F.lit("{"), F.array_join(F.transform("parts", lambda x: x.e), ","), F.lit("}")).alias("made"))
            maps = nodes.where(shared).select("_k", "path", "ord", "name")
            made = maps.join(parts, F.col("_k").eqNullSafe(F.col("_pk")) & (F.col("path") == F.col("_pp")), "left")
            done = done.unionByName(made.select("_k", "path", "ord", "name", F.coalesce("made", F.lit("{}")).alias("text")))
        below = done
    return below.select(F.col("_k").alias(key), F.col("text").alias(doc))


def list_union_col(t, s):
    """D2 as a JVM expression on two arrays of scalars (NULL-safe membership)."""
    tc, sc = F.col(t) if isinstance(t, str) else t, F.col(s) if isinstance(s, str) else s
    return F.concat(tc, F.filter(sc, lambda x: ~F.exists(tc, lambda y: y.eqNullSafe(x))))
