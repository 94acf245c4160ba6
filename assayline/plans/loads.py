"""Loads: from raw release rows to warehouse tables.

Every load is a lazy plan over all files at once; nothing loops over countries or files.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cached_property
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.columns import RELEASE_RENAMES, clean_columns, rename_columns
from ..functions.identity import canonical_number, number_text, tuple_hash
from ..functions.numbers import half_up_int
from ..functions.text import blank_to_null
from ..operators import cleaning, compare, dedup, dims, inserts, quality, reshape
from ..session import COMPACT, materialise, settings
from ..sources.registry import AmrRegistry, Registry

# Date parts in which a zero means "not given", whole table and before the
# check for duplicate samples.
EARLY_ZERO_COLUMNS = (
    "sampmatinfoprody", "sampmatinfoprodm", "sampmatinfoprodd",
    "analysisy", "analysism", "analysisd",
)
LATE_ZERO_COLUMNS = (
    "isolinfoisoly", "isolinfoisolm", "isolinfoisold",
    "isolinfoarrivalyisol", "isolinfoarrivalmisol", "isolinfoarrivaldisol",
    "sampaninfocompy", "sampaninfocompm", "sampaninfocompd",
    "sampmatinfoprody", "sampmatinfoprodm", "sampmatinfoprodd",
    "sampmatinfoexpiryy", "sampmatinfoexpirym", "sampmatinfoexpiryd",
    "sampeventinfoslaughtery", "sampeventinfoslaughterm", "sampeventinfoslaughterd",
    "sampinfoarrivaly", "sampinfoarrivalm", "sampinfoarrivald",
)
AMR_ZERO_COLUMNS = (
    "analysisd", "analysism", "analysisy", "isold", "isolm", "isoly", "sampd", "sampm", "sampy",
)

# Fixed values: (code column, dictionary, id column) of the sample table.
SAMPLE_CODES = (
    ("progtype", "prgtyp", "prgtyp_id"),
    ("labaccred", "labacc", "labacc_id"),
    ("labcountry", "country", "labcountry_id"),
    ("sampmethod", "sampmd", "sampmd_id"),
    ("sampstrategy", "sampstr", "sampstr_id"),
    ("anportsizeunit", "unit", "unit_id"),
    ("samppoint", "sampnt", "sampnt_id"),
    ("sampcountry", "country", "sampcountry_id"),
    ("origcountry", "country", "origcountry_id"),
)
SAMPLE_INTEGERS = ("anportseq", "sampy", "sampm", "sampd", "analysisy", "analysism", "analysisd", "repyear")
REQUIRED_SAMPLE_IDS = ("prgtyp_id", "sampstr_id", "sampnt_id", "sampcountry_id", "product_id", "file_id")

# Fixed values: (code column, dictionary, id column) of the measurement table.
MEASUREMENT_CODES = (
    ("restype", "valtyp", "restyp_id"),
    ("resunit", "unit", "resunit_id"),
    ("evalcode", "reseval", "evalcode_id"),
)

# Columns that the reader adds and that are not part of a release.
PLUMBING = ("release", "file", "file_path", "block", "position", "nr_cols", "nr_cells", "file_id", "filetype", "measurement_nr")


class Loaded(NamedTuple):
    """Rows to append and rows that were refused."""

    rows: DataFrame
    rejected: DataFrame


class Repair(NamedTuple):
    """A known defect of one file (named without its ending): copies of a sample that differ
    in one column."""

    file: str
    id_column: str
    column: str
    value: str


# Fixed value: the one file known to need a repair.
KNOWN_REPAIRS = (Repair("vmpr_2017_pt", "sampid", "sampsizeunit", "g050a"),)


def sample_hash(df: DataFrame, registry: Registry) -> Column:
    """Key of a sample: its identifiers and file, numbers by their value.

    ``''`` counts as missing, as it would after a bulk load, and so does a blank unit.  A column that is
    cast already is spelled from its value; one that is still text gives the same key.
    """
    kinds = registry.datatypes
    typed = dict(df.dtypes)
    cells = []
    for name in registry.identifiers:
        c = F.col(name)
        if "number" not in kinds[name]:
            cells.append(blank_to_null(c.cast("string")))
        else:
            cells.append(number_text(c) if typed[name] == "double" else canonical_number(c))
    return tuple_hash([*cells, F.col("file")])


def clean_release(
    raw: DataFrame, registry: Registry, columns: Sequence[str], zero_columns: Sequence[str] = EARLY_ZERO_COLUMNS,
    reader_sentinels: bool = False, losses: str | None = None,
) -> DataFrame:
    """Harmonise names, keep the given columns, clean cells, null sentinels and blanks, cast, null zeros.

    ``reader_sentinels`` also nulls what a CSV reader with default settings takes as missing.  With
    ``losses`` a column of that name lists the cells whose text is not the number it should be.
    """
    df = cleaning.harmonise(raw, RELEASE_RENAMES, columns, keep=PLUMBING)
    df = cleaning.filled_cells(df, skip=PLUMBING, reader_sentinels=reader_sentinels)
    if losses:
        df = cleaning.cast_with_losses(df, registry.datatypes, skip=PLUMBING, out=losses)
    else:
        df = cleaning.cast_by_registry(df, registry.datatypes, skip=PLUMBING)
    numbers = [c for c in zero_columns if "number" in registry.datatypes.get(c, "")]
    return cleaning.zeros_to_null(df, numbers)


class Cleaned(NamedTuple):
    """Release rows, cleaned and keyed once, for all loads.

    ``rows`` is a written table with ``samplehash``.  The counts were taken while it was written:
    all rows, cells that were no number, and rows of each known defective file (by repair).
    """

    rows: DataFrame
    n_rows: int
    n_malformed: int
    n_repairable: dict[str, int]

    @property
    def malformed(self) -> DataFrame:
        """Texts in number columns that became null: ``file``, ``column``, ``value`` and how often.  Only that list is read."""
        cells = self.rows.where(F.col("lost").isNotNull()).select("file", F.explode("lost").alias("cell"))
        return cells.groupBy("file", "cell.column", "cell.value").agg(F.count(F.lit(1)).alias("n"))


def _of_file(fix: Repair) -> Column:
    """The rows of the file of a repair, as a condition that a scan takes."""
    return (F.col("file") == fix.file) | F.col("file").startswith(fix.file + ".")


def stage_clean(
    raw: DataFrame, registry: Registry, columns: Sequence[str] | None = None, repairs: Sequence[Repair] = KNOWN_REPAIRS, reader_sentinels: bool = False,
) -> Cleaned:
    """Clean release rows, give each the key of its sample and write them, once for samples and measurements.

    ``columns`` are those to keep, by default all that the registry knows; identifiers always stay.
    """
    known = [*registry.sample_columns, *registry.core_measurement_columns, *registry.rest_measurement_columns]
    wanted = list(dict.fromkeys([*(known if columns is None else columns), *registry.identifiers]))
    df = clean_release(raw, registry, wanted, reader_sentinels=reader_sentinels, losses="lost")
    present = df.columns
    for name in registry.identifiers:
        df = cleaning.add_missing(df, [name], "double" if "number" in registry.datatypes[name] else "string")
    keyed = df.select(*present, *[c for c in df.columns if c not in present], sample_hash(df, registry).alias("samplehash"))
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.size("lost")), F.lit(0)).alias("malformed")]
    counts += [F.count_if(_of_file(fix)).alias(f"repair{i}") for i, fix in enumerate(repairs)]
    rows = materialise(keyed.observe(seen, *counts), "clean", COMPACT)
    got = seen.get
    return Cleaned(rows, got["rows"], got["malformed"], {fix.file: got[f"repair{i}"] for i, fix in enumerate(repairs)})


class Samples(NamedTuple):
    """Samples, files that were refused, and what shows why.

    ``keyed`` is ``rows`` with ``samplehash``; ``offending`` holds the rows of refused files that share
    a key; ``malformed`` the cells that were no number.
    """

    rows: DataFrame
    rejected: DataFrame
    keyed: DataFrame
    offending: DataFrame
    malformed: DataFrame


def samples_of(cleaned: Cleaned, registry: Registry, present: Sequence[str] | None = None, repairs: Sequence[Repair] = KNOWN_REPAIRS) -> Samples:
    """One row per sample and file, out of cleaned releases with one row per measurement.

    Rows equal in all sample columns are one sample.  A file in which two different rows
    share the sample key (``sample_hash``, the one definition of identity that all loads use)
    is left out whole, and listed in ``rejected``.  Keys are unique per file from there on, so
    nulling the later date parts cannot make two rows of a file equal, and no second
    de-duplication (a full shuffle) is needed.

    A known defect is repaired in the rows of its file alone, which the scan picks out; a load
    without that file has no job for it.  The distinct rows are written once: the check for repeated
    identifiers, and the loads of core and attributes after it, read back only the columns they need.
    """
    known = set(registry.sample_columns) if present is None else set(present)
    columns = [c for c in cleaned.rows.columns if c in known or c in ("file", "samplehash")]
    df = cleaned.rows.select(*columns)
    for fix in repairs:
        if fix.column in columns and cleaned.n_repairable.get(fix.file):
            keys = [c for c in columns if c in registry.identifiers]
            mended = dedup.repair_duplicates(df.where(_of_file(fix)), keys, fix.id_column, fix.column, F.lit(fix.value))
            if fix.column in registry.identifiers:
                mended = mended.withColumn("samplehash", sample_hash(mended, registry))
            df = df.where(~_of_file(fix)).unionByName(mended)
    # A key is half as long in bytes as in hex digits, and no codec of a shuffle can tell.
    short = df.withColumn("samplehash", F.unhex("samplehash")).dropDuplicates()
    keyed = materialise(short.withColumn("samplehash", F.lower(F.hex("samplehash"))), "samples", COMPACT)
    good, bad = dedup.split_bad_files(keyed, ["samplehash"])
    good = cleaning.zeros_to_null(good, LATE_ZERO_COLUMNS)
    scope = keyed.join(bad, "file", "left_semi")
    offending = scope.join(dedup.repeated_keys(scope, ["samplehash"]).select("samplehash"), "samplehash", "left_semi").select(*columns)
    return Samples(good.drop("samplehash"), bad, good, offending, cleaned.malformed)


def build_samples(raw: DataFrame, registry: Registry, repairs: Sequence[Repair] = KNOWN_REPAIRS, reader_sentinels: bool = False) -> Samples:
    """Samples of raw releases: ``samples_of`` what ``stage_clean`` keeps of them, in the columns that they have."""
    present = cleaning.harmonise(raw, RELEASE_RENAMES, registry.sample_columns).columns
    return samples_of(stage_clean(raw, registry, registry.sample_columns, repairs, reader_sentinels), registry, present, repairs)


class LoadedSamples(NamedTuple):
    """Rows to append, rows that were refused, and the numbers out of range that became null."""

    rows: DataFrame
    rejected: DataFrame
    out_of_range: DataFrame | None


def load_sample_core(
    samples: DataFrame, registry: Registry, dictionaries: dict[str, DataFrame], existing: DataFrame,
    required: Sequence[str] = REQUIRED_SAMPLE_IDS,
) -> LoadedSamples:
    """Core columns, hash, dictionary ids; only samples that are not stored yet.

    A row that lacks a mandatory id is refused alone, with the missing ids named; it does
    not abort the load.  A number that its whole-number column cannot hold becomes null and is
    reported.  The anti join comes before the dictionary joins, so stored samples are dropped early.
    """
    hashed = _keyed(samples, registry, registry.core_sample_columns)
    hashed = hashed.select(*dict.fromkeys([*registry.core_sample_columns, *registry.identifiers, "file", "samplehash"]))
    fresh = inserts.new_samples(hashed, existing)
    coded = dims.encode(fresh, [(code, dictionaries[d], i) for code, d, i in SAMPLE_CODES if code in fresh.columns and d in dictionaries])
    coded = dims.resolve_product(coded, "sampmatcodebasebuilding", dictionaries["mtx"], dictionaries["matrix"], dictionaries["products"])
    files = dictionaries["files"].groupBy(F.lower("filename").alias("_file")).agg(F.min("id").alias("file_id"))
    coded = coded.join(files, F.lower("file") == F.col("_file"), "left").drop("_file")
    integers = [c for c in SAMPLE_INTEGERS if c in coded.columns]
    coded = coded.withColumns({f"_{c}": half_up_int(F.col(c)) for c in integers})
    lacking = [F.when(F.col(c).isNull(), F.lit(c)) for c in required]
    beyond = [F.when(F.col(c).isNotNull() & F.col(f"_{c}").isNull(), F.lit(c)) for c in integers]
    judged = coded.withColumns({"missing": F.concat_ws(",", *lacking), "overflow": F.concat_ws(",", *beyond)})
    whole = [F.col(f"_{c}").alias(c) if c in integers else F.col(c) for c in coded.columns if not (c.startswith("_") and c[1:] in integers)]
    # Both results, and the report, come from one run of the joins.
    staged = materialise(judged.select(*whole, "missing", "overflow", *[F.col(c).alias(f"given_{c}") for c in integers]), "coded-samples", COMPACT)
    plain = [c for c in staged.columns if not c.startswith("given_")]
    lost = F.filter(F.array(*[F.when(F.col(c).isNull() & F.col(f"given_{c}").isNotNull(), F.struct(F.lit(c).alias("column"), F.col(f"given_{c}").alias("value"))) for c in integers]), lambda x: x.isNotNull()) if integers else None
    out_of_range = staged.where("overflow <> ''").select("samplehash", "file", F.explode(lost).alias("cell")).select("samplehash", "file", "cell.column", "cell.value") if integers else None
    return LoadedSamples(
        staged.filter("missing = ''").select(*plain).drop("missing", "overflow"), staged.filter("missing <> ''").select(*plain).drop("overflow"), out_of_range,
    )


def _keyed(samples: DataFrame, registry: Registry, columns: Sequence[str] = ()) -> DataFrame:
    """Samples with their key and the identifiers and columns that they lack."""
    full = cleaning.add_missing(samples, [*columns, *registry.identifiers])
    return full if "samplehash" in full.columns else full.withColumn("samplehash", sample_hash(full, registry))


def stage_sample_rest(samples: DataFrame, registry: Registry) -> DataFrame:
    """Attributes outside the core, long: ``samplehash, file, variable, value``."""
    hashed = _keyed(samples, registry)
    attributes = [c for c in hashed.columns if c in registry.rest_sample_columns]
    return reshape.to_long(hashed, ["samplehash", "file"], attributes)


def load_sample_rest(
    samples: DataFrame, registry: Registry, core: DataFrame, existing: DataFrame
) -> DataFrame:
    """Attributes of stored samples that have none yet.

    Samples are matched while they are still one row each, and made long afterwards.
    """
    full = _keyed(samples, registry)
    attributes = [c for c in full.columns if c in registry.rest_sample_columns]
    hashed = full.select("samplehash", *attributes)
    matched = inserts.open_samples(hashed, core, existing)
    return inserts.code_attributes(reshape.to_long(matched, ["sample_core_id"], attributes), registry.ids)


class Measurements:
    """Rows with a stored sample, as ``core`` and attributes (``rest``), and those without one (``unmatched``).

    Core and attributes share a join, which is run and written when the first of them is asked for.
    """

    def __init__(self, join: Callable[[], DataFrame], split: Callable[[DataFrame], tuple[DataFrame, DataFrame]], unmatched: DataFrame):
        self._join, self._split, self.unmatched = join, split, unmatched

    @cached_property
    def _parts(self) -> tuple[DataFrame, DataFrame]:
        return self._split(self._join())

    @property
    def core(self) -> DataFrame:
        return self._parts[0]

    @property
    def rest(self) -> DataFrame:
        return self._parts[1]


def measurements_of(cleaned: Cleaned, registry: Registry, core_samples: DataFrame) -> Measurements:
    """Attach sample ids and split each cleaned row into core and attributes.

    The sample is found by its key instead of sixteen nullable columns.  Rows without a sample are
    returned apart.  Core and attributes come from one join, whose narrow rows are written once.
    """
    df = cleaned.rows
    for name in registry.core_measurement_columns:
        # Columns that no release has are added with the type the registry gives them.
        df = cleaning.add_missing(df, [name], "double" if "number" in registry.datatypes[name] else "string")
    attributes = [c for c in registry.rest_measurement_columns if c in df.columns]
    ids = ["file_id", "filetype", "measurement_nr"]
    # One row per key, whatever the stored table holds: a match must not multiply measurements.
    # Keys are shuffled as bytes, half as long as their hex digits.
    key = F.unhex("samplehash").alias("_key")
    lookup = core_samples.groupBy(key).agg(F.min("id").alias("sample_core_id"))
    narrow = df.select(key, *ids, *registry.core_measurement_columns, *attributes)

    def split(joined: DataFrame) -> tuple[DataFrame, DataFrame]:
        core = joined.select("sample_core_id", *registry.core_measurement_columns, *ids)
        return core, reshape.to_long(joined, ["sample_core_id", "file_id", "measurement_nr"], attributes, "columnname")

    lost = df.select("*", key).drop("lost", "samplehash").join(lookup, "_key", "left_anti")
    unmatched = lost.withColumn("samplehash", F.lower(F.hex("_key"))).select([c for c in df.columns if c != "lost"])
    return Measurements(lambda: materialise(narrow.join(lookup, "_key").drop("_key"), "measurements", COMPACT), split, unmatched)


def split_measurements(numbered: DataFrame, registry: Registry, core_samples: DataFrame, reader_sentinels: bool = False) -> Measurements:
    """``measurements_of`` raw release rows with ``file``, ``file_id``, ``filetype`` and ``measurement_nr``."""
    wanted = [*registry.core_measurement_columns, *registry.rest_measurement_columns]
    return measurements_of(stage_clean(numbered, registry, wanted, (), reader_sentinels), registry, core_samples)


def load_measurements(staged: DataFrame, dictionaries: dict[str, DataFrame], existing: DataFrame) -> Loaded:
    """Code the staged measurements and keep the new ones.

    ``rejected`` holds rows with an unknown parameter, and those that repeat the sample, parameter and
    result id of an earlier row of the batch, with the ``verdict``.  Rows that are stored already are
    no news and in neither.
    """
    judged = inserts.judge_measurements(staged, dictionaries["param"], existing)
    new = judged.where("verdict is null").drop("verdict")
    coded = dims.encode(new, [(c, dictionaries[d], i) for c, d, i in MEASUREMENT_CODES if c in new.columns and d in dictionaries])
    return Loaded(coded, judged.where("verdict in ('unknown_param', 'repeated')").drop("param_id"))


# Columns of the antimicrobial-resistance table that hold whole numbers.
AMR_INTEGERS = (
    "repyear", "zoonosiscc", "zoonosisst", "zoonosist", "cc", "st", "t",
    "totunitstested", "totunitspositive", "totsampunitstested", "totsampunitspositive",
    "seqd", "seqm", "labtotisol", "sampy", "sampm", "sampd", "isoly", "isolm", "isold",
    "analysisy", "analysism", "analysisd", "cutoffvalue", "seqy",
)


# Fixed value: the column that is unique in a file of the antimicrobial-resistance table.
AMR_KEY = "resultcode"


def load_amr(raw: DataFrame, registry: AmrRegistry, dictionaries: dict[str, DataFrame], file_col: str = "filename") -> Loaded:
    """Clean, merge, code and order the antimicrobial-resistance releases.

    A code that its dictionary lacks is refused with its row, because the id column could
    not hold it, and so is a row whose result code stands in an earlier row of its file (``refused``
    says which).  ``cutoffvalue`` is rounded for its whole-number column, so the value as given is
    kept next to it.
    """
    cells = raw.drop(file_col)
    names = clean_columns(cells).columns
    place = F.monotonically_increasing_id().alias("_nr")
    named = raw.select(*[F.col(f"`{old}`").alias(new) for old, new in zip(cells.columns, names)], file_col, place)
    df = cleaning.null_sentinel_cells(cleaning.clean_cells(named, skip=[file_col]), skip=[file_col])
    present = [c for c in AMR_ZERO_COLUMNS if c in df.columns]
    df = df.withColumns({c: F.col(c).try_cast("double") for c in present})
    df = cleaning.zeros_to_null(df, present)
    df = df.select(*[c for c in registry.kept if c in df.columns], file_col, "_nr")
    df = rename_columns(df, {k: v for k, v in registry.merges.items() if k in df.columns})

    catalogues = {c: d for c, d in registry.catalogues.items() if c in df.columns}
    for n, (column, dictionary) in enumerate(catalogues.items()):
        side = dims.one_per_code(dictionaries[dictionary]).select(F.col("termcode").alias(f"_code{n}"), F.col("id").alias(f"_id{n}"))
        df = df.join(side, F.col(column) == F.col(f"_code{n}"), "left").drop(f"_code{n}")
    unresolved = [
        F.when(F.col(c).isNotNull() & F.col(f"_id{n}").isNull(), F.lit(c)) for n, c in enumerate(catalogues)
    ]
    judged = df.withColumn("unresolved", F.concat_ws(",", *unresolved) if unresolved else F.lit(""))
    judged = materialise(judged, "amr")
    refused = F.when(F.col("unresolved") != "", "unresolved")
    if AMR_KEY in df.columns:
        again = judged.where(F.col("unresolved").eqNullSafe("") & F.col(AMR_KEY).isNotNull()).groupBy(file_col, AMR_KEY)
        again = again.agg(F.count(F.lit(1)).alias("_n"), F.min("_nr").alias("_first")).where("_n > 1").drop("_n")
        judged = judged.join(again, [file_col, AMR_KEY], "left")
        refused = refused.when(F.col("_nr") != F.col("_first"), "repeated")
    judged = judged.withColumn("refused", refused).drop("_nr", "_first")

    ids = {c: f"_id{n}" for n, c in enumerate(catalogues)}
    out = []
    for spec in registry.merged:
        name = spec.merged_name
        if spec.drop or name not in df.columns or name == file_col:
            continue
        if name in ids:
            out.append(F.col(ids[name]).alias(spec.db_name))
        elif spec.db_name in AMR_INTEGERS:
            out.append(half_up_int(F.col(name).try_cast("double")).alias(spec.db_name))
            if spec.db_name == "cutoffvalue":
                out.append(F.col(name).try_cast("double").alias("cutoffvalue_exact"))
        else:
            out.append(F.col(name).alias(spec.db_name))
    good = judged.filter("refused is null").select(*out, file_col)
    return Loaded(good, judged.filter("refused is not null").drop(*ids.values()))


class RoundTrip(NamedTuple):
    """What a comparison of releases with the warehouse finds.

    ``files`` lists the files that differ and in which columns; ``changed`` the cells that both sides
    have with another value; ``missing`` those that one side lacks (``only_in``: ``original`` or
    ``warehouse``), those of rows that one side lacks included.
    """

    files: DataFrame
    changed: DataFrame
    missing: DataFrame


def compare_roundtrip(
    original: DataFrame, warehouse: DataFrame, ids: Sequence[str], columns: Sequence[str], file_col: str | None = None, chosen: DataFrame | None = None,
    stored: bool = False,
) -> RoundTrip:
    """Compare the original rows with the rebuilt ones.

    Both sides are brought to the same kind per column first (numbers where every value of the column is
    one), so ``1`` and ``1.0`` are not a difference.  Then each side gives one digest per file and
    column.  Only files whose digests differ are opened: their rows meet in wide form, and only cells
    that differ become rows.  ``file_col`` is by default the first of ``ids``.  ``chosen`` limits the
    comparison to some files (``quality.choose_files``).  Both sides are written first, unless they are
    ``stored`` tables already.
    """
    keys, file_col = list(ids), file_col or ids[0]
    shared = [c for c in columns if c in original.columns and c in warehouse.columns]
    sides = []
    for df, name in ((original, "original"), (warehouse, "warehouse")):
        if chosen is not None:
            df = df.join(chosen.select(file_col).distinct(), file_col, "left_semi")
        staged = df.select(*keys, *shared) if stored and chosen is None else materialise(df.select(*keys, *shared), name)
        sides.append(cleaning.best_effort_cast(staged, skip=keys))
    # A column that is a number on one side only is compared as text.
    kinds = [dict(df.dtypes) for df in sides]
    odd = [c for c in shared if kinds[0][c] != kinds[1][c]]
    sides = [df.withColumns({c: F.col(c).cast("string") for c in odd}) if odd else df for df in sides]
    files = materialise(compare.differing_files(sides[0], sides[1], file_col, keys, shared), "differing-files")
    opened = [df.join(files.select(file_col), file_col, "left_semi") for df in sides]
    # Both sides lie by the hash of their keys, which is enough for a join on it and the keys.
    with settings(original.sparkSession, spark__sql__requireAllClusterKeysForCoPartition="false"):
        cells = materialise(compare.differing_cells(opened[0], opened[1], keys, shared), "differing-cells")
    both = F.col("value_x").isNotNull() & F.col("value_y").isNotNull()
    only = F.when(F.col("value_y").isNull(), "original").otherwise("warehouse")
    missing = cells.where(~both).select(*keys, "variable", F.coalesce("value_x", "value_y").alias("value"), only.alias("only_in"))
    return RoundTrip(files, cells.where(both), missing)


def roundtrip_differences(
    original: DataFrame, warehouse: DataFrame, ids: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Cells of the original rows that the rebuilt rows hold with another value (see ``compare_roundtrip``)."""
    return compare_roundtrip(original, warehouse, ids, columns).changed


def verify_some_files(
    original: DataFrame, warehouse: DataFrame, ids: Sequence[str], columns: Sequence[str], n: int = 5, seed: int = 0, file_col: str | None = None,
) -> RoundTrip:
    """``compare_roundtrip`` of a repeatable choice of ``n`` files of the original."""
    name = file_col or ids[0]
    files = materialise(original.select(name).distinct(), "file-names")
    return compare_roundtrip(original, warehouse, ids, columns, name, materialise(quality.choose_files(files, n, seed, name), "chosen-files"))


def check_invariants(samples: DataFrame, rest: DataFrame, measurements: DataFrame) -> dict[str, DataFrame]:
    """The reports that must be empty after a load."""
    return {
        "duplicate_samples": quality.unique_violations(samples, ["samplehash"]),
        "orphan_attributes": quality.orphans_by_file(rest, samples, "samplehash"),
        "duplicate_measurements": quality.unique_violations(measurements, ["file_id", "measurement_nr", "filetype"]),
        "unknown_types": quality.domain_violations(measurements, "filetype", ["pesticides", "chemical", "vmpr"]),
    }
