"""Lookups and existence tests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lithic.functions.changes import all_of
from lithic.functions.text import as_column
from lithic.sources.shared import stable, stable_with

# A side is broadcast only when its measured values fit in this many bytes.
BROADCAST_BYTES = 64 * 1024 * 1024
# Values take at most so many times the bytes of their Parquet files, as lookups have a row per key.
EXPANSION = 32
# A shuffled lookup is hashed rather than sorted if its values take no more than this in an even shuffle partition.
HASHED_BYTES = 16 * 1024 * 1024
# Buckets per shuffle partition in which keys are counted in search of hot ones.
HASH_BUCKETS = 64
# Types whose values take no more than the overhead that is counted anyway.
FLAT = frozenset("boolean byte short integer long float double date timestamp timestamp_ntz void".split())


def measured_bytes(df: DataFrame) -> int:
    """Size of the values of ``df`` from one aggregate over it, 16 bytes of overhead per value.

    Arrays, structs and maps count as long as their JSON text, and 16 bytes for each of its commas.
    """
    return df.agg(_bytes(df).alias("n")).first()["n"] or 0


def _bytes(df: DataFrame) -> Column:
    width = [F.lit(16 * max(1, len(df.columns)))]
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        if kind in ("string", "binary", "decimal"):
            width.append(F.coalesce(F.octet_length(F.col(f.name).cast("string")), F.lit(0)))
        elif kind in ("array", "struct", "map"):
            text = F.to_json(F.struct(F.col(f.name)))
            width.append(F.octet_length(text) + 16 * (F.length(text) - F.length(F.replace(text, F.lit(","), F.lit("")))))
        elif kind not in FLAT:
            raise TypeError(f"the size of a {kind} column can't be measured")
    return F.sum(sum(width[1:], width[0]).cast("long"))


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= max_bytes


def sized(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """``df``, to be read again at no great cost, and whether its values fit in ``max_bytes``; see ``weighed``."""
    df, n = weighed(df, max_bytes)
    return df, n <= max_bytes


def weighed(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, int]:
    """``df``, to be read again at no great cost, and the bytes of its values, 0 if their files are small enough.

    What is read straight from files that are much smaller than that fits by their size; what is merely read is measured
    by reading it. All else is written once and measured on the way, so that its joins and aggregations don't run twice.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    if not _merely_read(plan):
        written, found = stable_with(df, {"bytes": _bytes(df)})
        return written, found["bytes"]
    on_disk = str(plan.stats().sizeInBytes())
    if _leaf(plan).nodeName().startswith("LogicalRelation") and int(on_disk) * EXPANSION <= max_bytes:
        return df, 0
    return df, measured_bytes(df)


def _leaf(plan):
    while plan.children().size():
        plan = plan.children().apply(0)
    return plan


def _merely_read(plan) -> bool:
    """Whether a plan only filters and computes columns of one table."""
    while plan.children().size():
        if plan.nodeName() not in ("Project", "Filter"):
            return False
        plan = plan.children().apply(0)
    return True


def has_hot_keys(df: DataFrame, on: Sequence[str]) -> bool:
    """Whether a key may have more rows than an even share of a shuffle partition: False only if none has.

    Keys are counted by buckets of their hashes, which a task sums up before the shuffle however many keys there are.
    """
    partitions = _partitions(df)
    bucket = F.pmod(F.xxhash64(*on), F.lit(HASH_BUCKETS * partitions)).alias("_bucket")
    top = df.groupBy(bucket).agg(F.count(F.lit(1)).alias("_rows")).agg(F.max("_rows"), F.sum("_rows")).first()
    return (top[0] or 0) > _share(top[1], partitions)


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _share(rows: int | None, partitions: int) -> int:
    return max(1, -(-(rows or 0) // partitions))


def hot_keys(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys with more rows than an even share of a shuffle partition, and over how many salts to spread them.

    There are fewer of them than partitions, whatever the data.
    """
    counts = stable(df.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows")))
    share = _share(counts.agg(F.sum("_rows")).first()[0], _partitions(df))
    hot = counts.where(F.col("_rows") > share)
    return hot.select(*(F.col(c).alias(f"_hot{i}") for i, c in enumerate(on)), F.ceil(F.col("_rows") / share).alias("_salts"))


def lookup_join(
    left: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    max_bytes: int = BROADCAST_BYTES,
    salts: int | None = None,
) -> DataFrame:
    """Join ``left`` to a lookup that has at most one row per key.

    A lookup whose size fits is broadcast. A larger one is joined by shuffle, and hashed where its partitions are small,
    so that the rows of ``left`` need no sorting. If there are hot keys, the rows
    of a hot key (or of NULL keys) are spread over as many salts as the key has shares of a shuffle
    partition, or over ``salts``, and only the lookup's rows of hot keys are repeated. The salt
    depends on the row and its input partition only: equal rows spread too, and a task that is run
    again salts its rows as before.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"a lookup join is left, inner, left_semi or left_anti, not {how}")
    lookup, size = weighed(lookup, max_bytes)
    if size <= max_bytes:
        return left.join(F.broadcast(lookup), list(on), how)
    if salts is None and not has_hot_keys(left, on):
        return left.join(lookup.hint("shuffle_hash" if size <= HASHED_BYTES * _partitions(left) else "merge"), list(on), how)
    hot = hot_keys(left, on)
    if salts is not None:
        hot = hot.withColumn("_salts", F.lit(salts).cast("long"))
    named = [f"_hot{i}" for i in range(len(on))]

    def with_salts(df: DataFrame) -> DataFrame:
        # Fewer rows than shuffle partitions.
        same = all_of(df[c].eqNullSafe(hot[h]) for c, h in zip(on, named))
        return df.join(F.broadcast(hot), same, "left").drop(*named).withColumn("_salts", F.coalesce("_salts", F.lit(1)))

    spread = F.xxhash64(*left.columns, F.spark_partition_id())
    salted = with_salts(left).withColumn("_salt", F.pmod(spread, "_salts")).drop("_salts")
    numbers = F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1)
    repeated = with_salts(lookup).withColumn("_salt", F.explode(numbers)).drop("_salts")
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")


Pairs = Mapping[str, tuple[Column, Column]] | Sequence[str]


def anti_join(left: DataFrame, right: DataFrame, on: Pairs, null_safe: bool = False) -> DataFrame:
    """Rows of ``left`` without a partner in ``right``.

    ``on`` is a list of shared names, or pairs of key expressions computed once per side. A NULL
    key has no partner, unless ``null_safe``.
    """
    keyed, mine, theirs = _keyed(left, right, on)
    present = theirs.distinct()
    return keyed.join(present, _match(keyed, mine, present, null_safe), "left_anti").select(*left.columns)


def anti_join_few(
    left: DataFrame, right: DataFrame, on: Pairs, null_safe: bool = False, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``anti_join`` for a few rows against a large table.

    When the measured keys of ``left`` fit, they are broadcast to find the rows of ``right`` that
    matter, so the large table is scanned but not shuffled. An estimate tells keys that are far beyond that, which
    need not be collected and measured. Of these the rows whose keys have a hash that no key of ``right`` has are told
    by their hashes alone, and only the others are joined; ``left`` and ``right`` should be written tables.
    """
    keyed, mine, theirs = _keyed(left, right, on)
    if _estimated_bytes(keyed.select(*mine)) > 2 * max_bytes:
        return _anti_join_of_met(keyed, mine, theirs, null_safe, max_bytes).select(*left.columns)
    wanted, small = sized(keyed.select(*mine).distinct(), max_bytes)
    if not small:
        return anti_join(left, right, on, null_safe)
    met = theirs.join(F.broadcast(wanted), _match(wanted, mine, theirs, null_safe), "left_semi").distinct()
    return keyed.join(met, _match(keyed, mine, met, null_safe), "left_anti").select(*left.columns)


def _anti_join_of_met(
    keyed: DataFrame, mine: Sequence[str], theirs: DataFrame, null_safe: bool, max_bytes: int
) -> DataFrame:
    """``anti_join``, after the rows that no hash of a key of ``theirs`` meets are taken out, if few are left then.

    Only hashes are shuffled for that. Equal keys have equal hashes, and what has one hash is compared by its keys.
    """
    if hashes_tell(keyed, mine) and [t for _, t in theirs.dtypes] == [dict(keyed.dtypes)[c] for c in mine]:
        sides = keyed.select(hash_of(mine), F.lit(True).alias("_mine")).unionByName(
            theirs.select(hash_of(theirs.columns), F.lit(False).alias("_mine"))
        )
        met = sides.groupBy(HASH).agg(F.count_if("_mine").alias("_left"), F.count_if(~F.col("_mine")).alias("_right"))
        both = met.where("_left > 0 and _right > 0").select(HASH)
        found, seen = stable_with(both, {"bytes": _bytes(both)})
        if seen["bytes"] <= max_bytes:
            unmet, others = parted(keyed, mine, found)
            partners = parted(theirs, theirs.columns, found)[1]
            return unmet.unionByName(others.join(partners, _match(others, mine, partners, null_safe), "left_anti"))
    present = theirs.distinct()
    return keyed.join(present, _match(keyed, mine, present, null_safe), "left_anti")


# Types whose equal values have equal hashes, unlike 0.0 and -0.0 or text under a collation.
EXACT = frozenset("boolean tinyint smallint int bigint date timestamp timestamp_ntz string binary".split())
HASH = "_hash"


def hashes_tell(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether equal values of these columns always have equal hashes."""
    types = dict(df.dtypes)
    return all(types[k] in EXACT for k in keys)


def hash_of(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys).alias(HASH)


def parted(df: DataFrame, keys: Sequence[str], hashes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose keys have none of a few ``hashes``, and the others."""
    hashed = df.withColumn(HASH, hash_of(keys))
    return tuple(hashed.join(F.broadcast(hashes), HASH, how).select(*df.columns) for how in ("left_anti", "left_semi"))


def _estimated_bytes(df: DataFrame) -> float:
    """About the size of the distinct rows of ``df``, from one pass without a shuffle of them."""
    found = df.agg(
        F.approx_count_distinct(F.xxhash64(*df.columns)).alias("rows"), F.count(F.lit(1)).alias("of"), _bytes(df).alias("n")
    ).first()
    return found["rows"] * (found["n"] or 0) / max(1, found["of"])


def _keyed(left: DataFrame, right: DataFrame, on: Pairs) -> tuple[DataFrame, list[str], DataFrame]:
    """``left`` with its key columns, their names, and the key columns of ``right`` alone."""
    if not isinstance(on, Mapping):
        return left, list(on), right.select(*(F.col(c).alias(f"_right{i}") for i, c in enumerate(on)))
    mine = {f"_left{i}": a for i, (a, _) in enumerate(on.values())}
    theirs = right.select(*(b.alias(f"_right{i}") for i, (_, b) in enumerate(on.values())))
    return left.withColumns(mine), list(mine), theirs


def _match(keyed: DataFrame, mine: Sequence[str], theirs: DataFrame, null_safe: bool) -> Column:
    pairs = zip((keyed[a] for a in mine), (theirs[b] for b in theirs.columns))
    return all_of(a.eqNullSafe(b) if null_safe else a == b for a, b in pairs)


def smallest_per_name(lookup: DataFrame, name: str, key: str) -> DataFrame:
    """One row per name with its lowest id (numeric order), the id still as text."""
    number = F.col(key).try_cast("decimal(38,0)")
    return (
        lookup.where(F.col(name).isNotNull())
        .groupBy(name)
        .agg(F.min(F.struct(number.alias("_n"), F.col(key).alias("_id"))).alias("_low"))
        .select(name, F.col("_low._id").alias(key))
    )


def fill_key(
    df: DataFrame, lookup: DataFrame, name: str, lookup_name: str, key: str, lookup_key: str | None = None
) -> DataFrame:
    """Set ``key`` from the lookup by name where it is NULL or '-1'; without a match it stays."""
    found = smallest_per_name(lookup, lookup_name, lookup_key or key).select(
        F.col(lookup_name).alias(name), F.col(lookup_key or key).alias("_found")
    )
    wanted = F.col(key).isNull() | (F.col(key) == "-1")
    joined = lookup_join(df, found, [name], "left")
    value = F.when(wanted & F.col("_found").isNotNull(), F.col("_found")).otherwise(F.col(key))
    return joined.withColumn(key, value).select(*df.columns)


def match_parents(df: DataFrame, parents: Sequence[tuple[DataFrame, str, Mapping[str, str]]]) -> DataFrame:
    """Inner join of a bridge to its parents, dropping pairs with a missing parent.

    Each parent is (table, bridge column, {parent column: output column}); the parent column listed
    first is the one the bridge column refers to.
    """
    for parent, column, outputs in parents:
        key = next(iter(outputs))
        picked = parent.select(
            F.col(key).alias(column), *(F.col(c).alias(o) for c, o in outputs.items() if o != column)
        )
        df = lookup_join(df, picked, [column], "inner")
    return df


def orphans(df: DataFrame, key: Column | str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose non-NULL key has no row in ``parent``."""
    k = as_column(key)
    keyed = df.where(k.isNotNull()).withColumn("_key", k)
    # The distinct keys meet the parent, so a hot key is one row there.
    lost = anti_join(keyed.select("_key").distinct(), parent, {"_key": (F.col("_key"), F.col(parent_key))})
    return lookup_join(keyed, lost, ["_key"], "left_semi").select(*df.columns)
