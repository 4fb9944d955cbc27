"""Source contracts: schema checks, join-key compatibility, type harmonisation.

Schema checks read only ``df.schema`` (no Spark job).  Key overlap never
brings keys to the driver: distinct keys of both sides are tagged, unioned
and grouped once by key (partial aggregation folds a hot key map-side), and a
second one-row aggregation counts left-only, right-only and matching keys.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from haulage.functions import count_where
from haulage.operators.sketches import THETA_LOG_ENTRIES, key_sketch, sketched_overlap
from haulage.plans.materialise import materialise
from haulage.schemas import JOIN_CONTRACTS, SOURCE_SPECS, JoinContract, SourceSpec, type_family


class ContractError(RuntimeError):
    """A join contract cannot be met; the pipeline stops before joining."""


@dataclass
class SchemaResult:
    valid: bool
    errors: list = field(default_factory=list)
    warnings: list = field(default_factory=list)


def _spec(spec: SourceSpec | str) -> SourceSpec | None:
    return spec if isinstance(spec, SourceSpec) else SOURCE_SPECS.get(spec)


def validate_schema(df: DataFrame, spec: SourceSpec | str) -> SchemaResult:
    """Required columns (errors) and type hints (warnings only)."""
    s = _spec(spec)
    if s is None:
        return SchemaResult(False, [f"no schema defined for source {spec!r}"], [])
    present = set(df.columns)
    missing = [c for c in s.required if c not in present]
    errors = [f"missing columns: {missing}"] if missing else []
    warnings = []
    types = {f.name: f.dataType for f in df.schema.fields}
    for col, hint in s.type_hints.items():
        if col in types and type_family(types[col]) != type_family(hint):
            warnings.append(f"column {col!r}: expected {hint}, found {types[col].simpleString()}")
    return SchemaResult(not errors, errors, warnings)


FINDINGS_SCHEMA = StructType(
    [
        StructField("source", StringType(), False),
        StructField("column_name", StringType(), False),
        StructField("data_type", StringType(), True),
        StructField("nullable", BooleanType(), True),
        StructField("required", BooleanType(), False),
        StructField("expected_type", StringType(), True),
        StructField("status", StringType(), False),
    ]
)


def schema_findings(df: DataFrame, spec: SourceSpec | str, with_null_counts: bool = False) -> DataFrame:
    """Column listing with a status per column: OK, MISSING, TYPE_WARNING, EXTRA.

    The listing comes from schema metadata (one row per column).  With
    ``with_null_counts`` each present column also gets its NULL count from one
    aggregation pass over the data (missing columns get NULL).
    """
    s = _spec(spec)
    name = s.name if s else str(spec)
    required = set(s.required) if s else set()
    hints = dict(s.type_hints) if s else {}
    rows = []
    fields = {f.name: f for f in df.schema.fields}
    for f in df.schema.fields:
        hint = hints.get(f.name)
        if hint and type_family(f.dataType) != type_family(hint):
            status = "TYPE_WARNING"
        elif f.name in required:
            status = "OK"
        else:
            status = "EXTRA"
        rows.append((name, f.name, f.dataType.simpleString(), f.nullable, f.name in required, hint, status))
    for col in (s.required if s else ()):
        if col not in fields:
            rows.append((name, col, None, None, True, hints.get(col), "MISSING"))
    if s is None:
        rows.append((name, "*", None, None, False, None, "UNKNOWN_SOURCE"))
    findings = df.sparkSession.createDataFrame(rows, FINDINGS_SCHEMA)
    if not with_null_counts or not df.columns:
        return findings
    from haulage.sources.profile import null_profile

    counts = null_profile(df, name, only_positive=False).select("column_name", "null_count")
    return findings.join(counts, on="column_name", how="left").select(*FINDINGS_SCHEMA.names, "null_count")


REPORT_SCHEMA = StructType(
    [
        StructField("contract", StringType(), False),
        StructField("description", StringType(), True),
        StructField("can_join", BooleanType(), False),
        StructField("issues", StringType(), False),
        StructField("left_unique_keys", LongType(), True),
        StructField("right_unique_keys", LongType(), True),
        StructField("matching_keys", LongType(), True),
        StructField("left_keys_no_match", LongType(), True),
        StructField("match_rate", StringType(), True),
    ]
)


def _contract(contract: JoinContract | str) -> JoinContract:
    if isinstance(contract, JoinContract):
        return contract
    return JOIN_CONTRACTS[contract]  # unknown name -> KeyError, as documented


def contract_issues(left: DataFrame, right: DataFrame, contract: JoinContract | str) -> tuple[bool, list[str], bool]:
    """Metadata checks: (can_join, issues, keys_present)."""
    c = _contract(contract)
    issues = []
    if c.left_key not in left.columns:
        issues.append(f"left table lacks join key {c.left_key!r}")
    if c.right_key not in right.columns:
        issues.append(f"right table lacks join key {c.right_key!r}")
    if issues:
        return False, issues, False
    lt = type_family(left.schema[c.left_key].dataType)
    rt = type_family(right.schema[c.right_key].dataType)
    can_join = True
    if lt != type_family(c.expected_type):
        issues.append(f"left key type: expected {c.expected_type}, found {left.schema[c.left_key].dataType.simpleString()}")
    if lt != rt:
        issues.append(
            f"key type mismatch: left {c.left_key!r} is {left.schema[c.left_key].dataType.simpleString()}, "
            f"right {c.right_key!r} is {right.schema[c.right_key].dataType.simpleString()}"
        )
        can_join = False
    return can_join, issues, True


def _same_family(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> bool:
    families = {type_family(left.schema[left_key].dataType), type_family(right.schema[right_key].dataType)}
    return len(families) == 1 or families == {"integer", "float"}  # numbers compare by value


def _comparable(left: DataFrame, right: DataFrame, left_key: str, right_key: str):
    """Both keys as columns of one type; across type families a (side, text) pair, so that none is equal."""
    lcol, rcol = F.col(left_key), F.col(right_key)
    if _same_family(left, right, left_key, right_key):
        return lcol, rcol  # the union widens, it never narrows

    def sided(col, side):
        return F.when(col.isNotNull(), F.struct(F.lit(side).alias("side"), col.cast("string").alias("text")))

    return sided(lcol, 0), sided(rcol, 1)


def key_overlap(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """One row: distinct keys per side, matching keys, left-only keys (NULLs ignored).

    Keys of different type families never match (1000 is not "1000"), so
    nothing is cast across families.
    """
    lcol, rcol = _comparable(left, right, left_key, right_key)
    lk = left.select(lcol.alias("_k"), F.lit(True).alias("_l"), F.lit(False).alias("_r"))
    rk = right.select(rcol.alias("_k"), F.lit(False).alias("_l"), F.lit(True).alias("_r"))
    per_key = (
        lk.unionByName(rk)
        .where(F.col("_k").isNotNull())
        .groupBy("_k")
        .agg(F.bool_or("_l").alias("_l"), F.bool_or("_r").alias("_r"))
    )
    return per_key.agg(
        count_where(F.col("_l")).alias("left_unique_keys"),
        count_where(F.col("_r")).alias("right_unique_keys"),
        count_where(F.col("_l") & F.col("_r")).alias("matching_keys"),
        count_where(F.col("_l") & ~F.col("_r")).alias("left_keys_no_match"),
    )


def approx_key_overlap(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, log_entries: int = THETA_LOG_ENTRIES
) -> DataFrame:
    """Sketch-based key overlap with intervals (one row), for profiling very large tables.

    Each side becomes one theta sketch, aggregated map-side; keys are never
    shuffled.  Common and left-only keys come from the sketches' intersection
    and difference, so small overlaps are found as well (``haulage.operators.sketches``).
    """
    if _same_family(left, right, left_key, right_key):
        lcol, rcol = (F.col(left_key), F.col(right_key)) if _text_keys(left, left_key) else (_number(left_key), _number(right_key))
    else:
        # Keys of different types never match.
        lcol, rcol = F.concat(F.lit("l"), F.col(left_key).cast("string")), F.concat(F.lit("r"), F.col(right_key).cast("string"))
    return sketched_overlap(key_sketch(left, lcol, log_entries), key_sketch(right, rcol, log_entries))


def _text_keys(df: DataFrame, key: str) -> bool:
    return type_family(df.schema[key].dataType) not in ("integer", "float")


def _number(key: str):
    """A numeric key in one form for both sides: whole numbers by their digits, others by the double's text."""
    c = F.col(key)
    whole = c.try_cast("bigint")
    return F.when(c == whole, whole.cast("string")).otherwise(c.cast("double").cast("string"))


BLOOM_BITS = 16  # bits of filter a key: about one false "maybe" in 200
BLOOM_BYTES = 32 << 20  # no filter beyond this is built
BLOOM_TESTS = 5


def _bloom_place(key, words: int):
    """A key's place in a blocked filter: one 64-bit word and ``BLOOM_TESTS`` bits within it."""
    text = key.cast("string")
    word = F.pmod(F.xxhash64(F.lit(11), text), F.lit(words).cast("bigint"))
    bits = F.xxhash64(F.lit(12), text)
    mask = F.lit(0).cast("bigint")
    for i in range(BLOOM_TESTS):
        place = F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    return word, mask


def bloom_filter(keys: DataFrame, key: str, n_keys: int) -> tuple[DataFrame, int]:
    """A blocked Bloom filter as a table ``(_word, _bits)``: one row a 64-bit word, OR-ed together in the executors.

    Returns it with its number of words, which follows from the key count.
    """
    words = max(1, -(-n_keys * BLOOM_BITS // 64))
    word, mask = _bloom_place(F.col(key), words)
    rows = keys.where(F.col(key).isNotNull()).select(word.alias("_word"), mask.alias("_mask"))
    return rows.groupBy("_word").agg(F.bit_or("_mask").alias("_bits")), words


def unmatched_keys_filtered(
    left: DataFrame,
    right: DataFrame,
    contract: JoinContract | str,
    max_bytes: int = BLOOM_BYTES,
) -> DataFrame:
    """``unmatched_keys`` through a Bloom filter of the right keys; the same rows.

    A left key that the filter does not hold has no partner and is answered in
    the task that read it.  Only keys that the filter can't decide meet the
    right side, in an exact anti join.  The filter has ``BLOOM_BITS`` bits a
    right key (an HLL count, plus its error) and is broadcast, so one of more
    than ``max_bytes`` is not built, and the plain anti join answers.
    """
    undecided, misses = split_by_filter(left, right, contract, max_bytes)
    if misses is None:
        return unmatched_keys(left, right, contract)
    c, _, rk = _key_frames(left, right, contract)
    return misses.distinct().unionByName(undecided.distinct().join(rk, on=c.left_key, how="left_anti"))


def split_by_filter(
    left: DataFrame, right: DataFrame, contract: JoinContract | str, max_bytes: int = BLOOM_BYTES
) -> tuple[DataFrame, DataFrame | None]:
    """Left keys (not yet distinct) as (those a filter of the right keys may hold, those it surely doesn't).

    Without a filter (too large, or keys of different types) the second is None.
    """
    c, lk, rk = _key_frames(left, right, contract)
    keys = left.select(c.left_key).where(F.col(c.left_key).isNotNull())
    same = rk is not None and left.schema[c.left_key].dataType.typeName() == right.schema[c.right_key].dataType.typeName()
    if not same:
        return keys, None
    n = right.agg(F.approx_count_distinct(c.right_key, 0.05).alias("n")).first()["n"]
    n = int(n * 1.2) + 64
    if n * BLOOM_BITS // 8 > max_bytes:
        return keys, None
    filter_rows, words = bloom_filter(right.select(c.right_key), c.right_key, n)
    table = materialise(filter_rows, "key-filter")
    word, mask = _bloom_place(F.col(c.left_key), words)
    # At most ``max_bytes`` of bits and as much again of word numbers.
    probed = keys.join(F.broadcast(table), word == F.col("_word"), "left")
    maybe = F.coalesce(F.col("_bits").bitwiseAND(mask) == mask, F.lit(False))
    return probed.where(maybe).select(c.left_key), probed.where(~maybe).select(c.left_key)


def join_report(
    left: DataFrame, right: DataFrame, contract: JoinContract | str, exact: bool = True
) -> DataFrame:
    """Contract report (one row): can_join, issues, key statistics, match rate.

    ``exact=False`` uses sketches (``approx_key_overlap``) instead of a grouped
    pass over distinct keys, and adds a column ``estimated`` that says so and
    the interval of the matching keys.
    """
    c = _contract(contract)
    can_join, issues, keys_present = contract_issues(left, right, c)
    if not keys_present:
        row = (c.name, c.description, False, "; ".join(issues), None, None, None, None, None)
        return left.sparkSession.createDataFrame([row], REPORT_SCHEMA).withColumn(
            "match_rate_pct", F.lit(None).cast("double")
        )
    overlap = key_overlap if exact else approx_key_overlap
    stats = overlap(left, right, c.left_key, c.right_key)
    rate = F.try_divide(F.col("matching_keys").cast("double"), F.col("left_unique_keys").cast("double")) * F.lit(100.0)
    marks = [] if exact else [F.lit(True).alias("estimated"), "matching_low", "matching_high"]
    return stats.select(
        F.lit(c.name).alias("contract"),
        F.lit(c.description).alias("description"),
        F.lit(can_join).alias("can_join"),
        F.lit("; ".join(issues)).alias("issues"),
        "left_unique_keys",
        "right_unique_keys",
        "matching_keys",
        "left_keys_no_match",
        F.when(F.col("left_unique_keys") == 0, F.lit("0%"))
        .otherwise(F.concat(F.format_number(rate, 1), F.lit("%")))
        .alias("match_rate"),
        rate.alias("match_rate_pct"),
        *marks,
    )


def _key_frames(left: DataFrame, right: DataFrame, contract: JoinContract | str):
    c = _contract(contract)
    # Both sides are reduced to distinct keys first (partial aggregation), so a
    # key holding a large share of either table is one row before the join.
    lk = left.select(F.col(c.left_key)).where(F.col(c.left_key).isNotNull()).distinct()
    rk = right.select(F.col(c.right_key).alias(c.left_key)).where(F.col(c.left_key).isNotNull()).distinct()
    return c, lk, rk if _same_family(left, right, c.left_key, c.right_key) else None


def matched_keys(left: DataFrame, right: DataFrame, contract: JoinContract | str) -> DataFrame:
    """Distinct left keys that have a partner on the right (key intersection)."""
    c, lk, rk = _key_frames(left, right, contract)
    return lk.limit(0) if rk is None else lk.join(rk, on=c.left_key, how="left_semi")


def unmatched_keys(left: DataFrame, right: DataFrame, contract: JoinContract | str) -> DataFrame:
    """Distinct left keys without a partner on the right (key difference)."""
    c, lk, rk = _key_frames(left, right, contract)
    return lk if rk is None else lk.join(rk, on=c.left_key, how="left_anti")


def check_contract(
    left: DataFrame, right: DataFrame, contract: JoinContract | str, exact: bool = True
) -> dict:
    """Report as a dict (collects the one-row report); raises nothing."""
    row = join_report(left, right, contract, exact=exact).collect()[0].asDict()
    row["issues"] = [i for i in row["issues"].split("; ") if i] if row["issues"] else []
    return row


def _key_text(df: DataFrame, key: str, other: DataFrame, other_key: str, side: str):
    """A key as text that is equal for equal keys, so that contracts over keys of any type fit one table."""
    if not _same_family(df, other, key, other_key):
        return F.concat(F.lit(side), F.col(key).cast("string"))
    return F.col(key).cast("string") if _text_keys(df, key) else _number(key)


def key_overlaps(pairs) -> DataFrame:
    """Key statistics of several (left, right, contract) in one job: a row for each position in ``pairs``.

    All keys go, marked with their contract and side, through one aggregation
    by (contract, key), which folds a hot key map-side, and one by contract.  A
    table that serves several contracts is read once for all of them.
    """
    wanted: dict[int, tuple[DataFrame, list]] = {}
    for i, (left, right, contract) in enumerate(pairs):
        c = _contract(contract)
        sides = (
            (left, _key_text(left, c.left_key, right, c.right_key, "l"), True),
            (right, _key_text(right, c.right_key, left, c.left_key, "r"), False),
        )
        for df, key, is_left in sides:
            entry = F.struct(F.lit(i).alias("i"), key.alias("k"), F.lit(is_left).alias("l"))
            wanted.setdefault(id(df), (df, []))[1].append(entry)
    parts = [df.select(F.inline(F.array(*entries))) for df, entries in wanted.values()]
    keys = parts[0]
    for part in parts[1:]:
        keys = keys.unionByName(part)
    per_key = keys.where(F.col("k").isNotNull()).groupBy("i", "k").agg(
        F.bool_or("l").alias("_l"), F.bool_or(~F.col("l")).alias("_r")
    )
    return per_key.groupBy("i").agg(
        count_where(F.col("_l")).alias("left_unique_keys"),
        count_where(F.col("_r")).alias("right_unique_keys"),
        count_where(F.col("_l") & F.col("_r")).alias("matching_keys"),
        count_where(F.col("_l") & ~F.col("_r")).alias("left_keys_no_match"),
    )


def check_contracts(pairs, exact: bool = True) -> list[dict]:
    """``check_contract`` of every (left, right, contract), exact ones in a single job."""
    pairs = [(left, right, _contract(c)) for left, right, c in pairs]
    metadata = [contract_issues(*p) for p in pairs]
    if not exact or not all(present for _, _, present in metadata):
        return [check_contract(*p, exact=exact) for p in pairs]
    counts = {r["i"]: r.asDict() for r in key_overlaps(pairs).collect()}
    names = ("left_unique_keys", "right_unique_keys", "matching_keys", "left_keys_no_match")
    reports = []
    for i, ((_, _, c), (can_join, issues, _)) in enumerate(zip(pairs, metadata)):
        stats = {n: counts.get(i, {}).get(n, 0) for n in names}
        n_left = stats["left_unique_keys"]
        rate = 100.0 * stats["matching_keys"] / n_left if n_left else None
        reports.append(
            {
                "contract": c.name,
                "description": c.description,
                "can_join": can_join,
                "issues": issues,
                **stats,
                "match_rate": f"{rate:,.1f}%" if n_left else "0%",
                "match_rate_pct": rate,
            }
        )
    return reports


def require_contracts(pairs, exact: bool = True) -> list[dict]:
    """Check each (left, right, contract); raise ``ContractError`` if any cannot join."""
    reports = check_contracts(pairs, exact)
    bad = [r for r in reports if not r["can_join"]]
    if bad:
        raise ContractError("; ".join(f"{r['contract']}: {', '.join(r['issues'])}" for r in bad))
    return reports


def harmonize_and_recheck(
    left: DataFrame, right: DataFrame, contract: JoinContract | str, fill=None
) -> tuple[DataFrame, DataFrame, dict]:
    """Check a contract; if the key types block the join, convert both keys to
    the contract's expected type and check again.

    Returns ``(left, right, report)`` with the (possibly converted) frames and
    the final report.
    """
    c = _contract(contract)
    report = check_contract(left, right, c)
    if report["can_join"] or c.left_key not in left.columns or c.right_key not in right.columns:
        return left, right, report
    left = harmonize(left, c.left_key, c.expected_type, fill=fill)
    right = harmonize(right, c.right_key, c.expected_type, fill=fill)
    return left, right, check_contract(left, right, c)


def harmonize(df: DataFrame, column: str, target: str, fill=None) -> DataFrame:
    """Convert ``column`` to a target type family; returns a new DataFrame.

    ``int64``: numeric parse (non-numeric -> NULL), fractions truncated; whole
    numbers keep all 64 bits (they do not pass through a double);
    ``object``: text; ``float64``: numeric parse.  ``fill`` replaces NULLs after
    conversion (``fill=0`` reproduces the original NULL -> 0 behaviour).
    Other targets leave the column unchanged.
    """
    c = F.col(column)
    if target == "int64":
        src = df.schema[column].dataType.typeName()
        if src in ("byte", "short", "integer", "long"):
            out = c.cast("bigint")
        else:
            as_double = c.try_cast("double").try_cast("bigint")
            whole = c.rlike(r"^\s*[+-]?[0-9]+\s*$")
            out = F.when(whole, c.try_cast("bigint")).otherwise(as_double) if src == "string" else as_double
    elif target == "object":
        out = c.cast("string")
    elif target == "float64":
        out = c.try_cast("double")
    else:
        return df
    if fill is not None:
        out = F.coalesce(out, F.lit(fill).cast(out_type(target)))
    return df.withColumn(column, out)


def out_type(target: str) -> str:
    return {"int64": "bigint", "object": "string", "float64": "double"}[target]
