"""Dictionary coding, hierarchies and ordered rules.

No join here carries a broadcast hint.  Catalyst broadcasts a dictionary when its size on
disk, or its size measured at run time, is below ``spark.sql.autoBroadcastJoinThreshold``;
a larger one is shuffled, and AQE splits its hot codes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_per_code(dictionary: DataFrame, key: str = "termcode") -> DataFrame:
    """``key`` and ``id``, the least one of a code that is listed twice: coding must not multiply rows."""
    return dictionary.groupBy(key).agg(F.min("id").alias("id"))


def encode(df: DataFrame, codes: Sequence[tuple[str, DataFrame, str]], key: str = "termcode") -> DataFrame:
    """Replace codes by dictionary ids: ``(code column, dictionary, id column)`` per code.

    The same dictionary may be used under several roles.  An unknown code gives a null id, and a
    code that is listed twice its least id.
    """
    for code, dictionary, id_col in codes:
        side = one_per_code(dictionary, key).select(F.col(key).alias(f"_{id_col}_key"), F.col("id").alias(id_col))
        df = df.join(side, F.col(code) == F.col(f"_{id_col}_key"), "left").drop(f"_{id_col}_key")
    return df


def decode(df: DataFrame, labels: Sequence[tuple[str, DataFrame, dict[str, str]]]) -> DataFrame:
    """Add dictionary columns by id: ``(id column, dictionary, {dictionary column: new name})``."""
    for n, (id_col, dictionary, names) in enumerate(labels):
        side = dictionary.select(F.col("id").alias(f"_id{n}"), *[F.col(c).alias(new) for c, new in names.items()])
        df = df.join(side, F.col(id_col) == F.col(f"_id{n}"), "left").drop(f"_id{n}")
    return df


def resolve_product(df: DataFrame, code: str, mtx: DataFrame, matrix: DataFrame, products: DataFrame, out: str = "product_id") -> DataFrame:
    """Product id of a code: looked up in the first dictionary, else in the second."""
    # The rows are joined to one stored dictionary after the other.  Joining dictionaries to
    # each other first would hide their sizes, since a join is estimated as a product.
    for name, dictionary in (("mtx", mtx), ("matrix", matrix)):
        terms = one_per_code(dictionary).select(F.col("termcode").alias("_code"), F.col("id").alias(f"_{name}"))
        entries = products.select(F.col(f"{name}_id").alias("_entry"), F.col("id").alias(f"_{name}_product"))
        df = df.join(terms, F.col(code) == F.col("_code"), "left").join(entries, F.col(f"_{name}") == F.col("_entry"), "left").drop("_code", "_entry")
    chosen = F.when(F.col("_mtx").isNotNull(), F.col("_mtx_product")).otherwise(F.col("_matrix_product"))
    return df.withColumn(out, chosen).drop("_mtx", "_matrix", "_mtx_product", "_matrix_product")


def replace_by_dictionary(df: DataFrame, column: str, dictionary: DataFrame) -> DataFrame:
    """Replace texts that the dictionary knows by their id; other texts stay.

    The result is text, because the column may now hold both.
    """
    side = dictionary.select(F.col("termcode").alias("_code"), F.col("id").cast("string").alias("_id"))
    return df.join(side, F.col(column) == F.col("_code"), "left").select(*[
        F.coalesce(F.col("_id"), df[c]).alias(c) if c == column else df[c] for c in df.columns
    ])


def hierarchy_paths(terms: DataFrame, code: str, name: str, order: str | None = None, sep: str = "::", tag: str = "") -> DataFrame:
    """Spell out a dotted code as the names along it: ``1.4.7`` to ``a::b::c``.

    Returns ``(code, full_name)``, one row per code.  Where a code is listed twice the last
    name in ``order`` counts.  ``full_name`` is null if a code on the way is unknown.
    """
    coded = terms.filter(F.col(code).isNotNull())
    name_of = F.max_by(name, order) if order else F.max(name)
    names = coded.groupBy(F.col(code).alias("_code")).agg(name_of.alias("_name"))
    parts = F.split("_code", r"\.")
    steps = names.select(
        "_code", F.posexplode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "."))).alias("_level", "_step")
    )
    found = steps.join(names.select(F.col("_code").alias("_step"), "_name"), "_step", "left")
    # At most as many entries per code as the code has levels.
    walked = found.groupBy("_code").agg(
        F.array_sort(F.collect_list(F.struct("_level", "_name"))).alias("_path"),
        F.count(F.when(F.col("_name").isNull(), 1)).alias("_gaps"),
    )
    spelled = F.concat(F.lit(tag), F.array_join(F.transform("_path", lambda p: p["_name"]), sep))
    return walked.select(F.col("_code").alias(code), F.when(F.col("_gaps") == 0, spelled).alias("full_name"))


def product_names(products: DataFrame, mtx: DataFrame, matrix: DataFrame, mtx_code: str, matrix_code: str, name: str) -> DataFrame:
    """Tagged name and tagged full path of every product, the second dictionary first."""
    sides = []
    for tag, terms, code in (("matrix", matrix, matrix_code), ("mtx", mtx, mtx_code)):
        paths = hierarchy_paths(terms, code, name, tag=f"{tag}::")
        sides.append(
            terms.join(paths, code, "left").select(
                F.col("id").alias(f"{tag}_id"),
                F.concat(F.lit(f"{tag}::"), F.col(name)).alias(f"_{tag}_name"),
                F.col("full_name").alias(f"_{tag}_path"),
            )
        )
    joined = products.join(sides[0], "matrix_id", "left").join(sides[1], "mtx_id", "left")
    tagged = F.coalesce("_matrix_name", "_mtx_name")
    return joined.select(
        F.col("id").alias("product_id"),
        tagged.alias("product_name"),
        F.coalesce("_matrix_path", "_mtx_path", tagged).alias("full_name"),
    )


def ordered_rules(rules: DataFrame, item: str, category: str, order: str) -> DataFrame:
    """Rules as ``item, category, ordinal``, one per item: stripped, items in lower case.

    An item listed twice keeps its first place and takes its last category.
    """
    named = rules.select(F.lower(F.trim(item)).alias("item"), F.trim(category).alias("category"), F.col(order).alias("ordinal"))
    return named.where("item is not null").groupBy("item").agg(
        F.max_by("category", "ordinal").alias("category"), F.min("ordinal").alias("ordinal")
    )


def first_matching_category(df: DataFrame, label: str, rules: DataFrame, out: str = "category") -> DataFrame:
    """Add the category of the first rule whose item is contained in the label, else the label.

    The distinct labels are cut into their substrings of the lengths that occur among the
    items, which are then looked up: an equi-join, whatever the number of rules.
    """
    lengths = rules.agg(F.collect_set(F.length("item")).alias("n")).select("n").scalar()
    labels = df.select(F.col(label).alias("_label")).where("_label is not null").distinct()
    sized = labels.select("_label", F.explode(lengths).alias("_n")).where(F.length("_label") >= F.col("_n"))
    starts = sized.select("_label", "_n", F.explode(F.sequence(F.lit(1), F.length("_label") - F.col("_n") + 1)).alias("_at"))
    cut = starts.select("_label", F.substr(F.lower("_label"), F.col("_at"), F.col("_n")).alias("item")).distinct()
    found = cut.join(rules, "item").groupBy("_label").agg(F.min_by("category", "ordinal").alias("_category"))
    joined = df.join(found, F.col(label) == F.col("_label"), "left")
    return joined.withColumn(out, F.coalesce("_category", F.col(label))).drop("_label", "_category")
