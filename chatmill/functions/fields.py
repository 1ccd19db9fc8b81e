"""Field-by-field comparison of an extracted object with its ground truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatmill.functions.repair import FIELD_VIEW, clean_reply, field_views
from chatmill.functions.text import strip
from chatmill.schemas import PROFILE_FIELDS, FieldSpec


def _same(p: Column, t: Column) -> Column:
    """Equality of two field views: lists as bags, texts without case, all else by value."""

    def fold(x: Column) -> Column:
        return F.lower(strip(x))

    return (
        F.when((p["k"] == "list") & (t["k"] == "list"), F.sort_array(F.transform(p["l"], fold)) == F.sort_array(F.transform(t["l"], fold)))
        .when((p["k"] == "text") & (t["k"] == "text"), fold(p["s"]) == fold(t["s"]))
        .otherwise((p["k"] == t["k"]) & (p["k"] != "nan") & p["s"].eqNullSafe(t["s"]))
    )


def score_fields(
    df: DataFrame,
    raw: str = "raw_response",
    truth: str = "ground_truth",
    fields: tuple[FieldSpec, ...] = PROFILE_FIELDS,
) -> DataFrame:
    """Add `predicted` (JSON text), `strategy`, `status`, a `field_<name>` flag per field and their totals.

    A reply that holds no object is a `parse_error` and compares as an empty object.
    """
    names = [f.name for f in fields]
    df = df.withColumn("__v", field_views(names)(clean_reply(F.col(raw)), F.col(truth)))
    p, t = (F.from_json(f"__v.{side}_view", FIELD_VIEW) for side in ("reply", "truth"))
    df = df.withColumns(
        {
            "predicted": F.col("__v.json"),
            "strategy": F.col("__v.strategy"),
            "status": F.when(F.col("__v.json").isNull(), "parse_error").otherwise("ok"),
            "__same": F.zip_with(p, t, _same),
        }
    )
    df = df.withColumns({f"field_{n}": F.get("__same", F.lit(i)) for i, n in enumerate(names)})
    matched = F.size(F.filter("__same", lambda same: same))
    df = df.withColumns({"fields_matched": matched, "fields_total": F.lit(len(names))})
    return df.withColumn("field_accuracy", F.bround(F.col("fields_matched") / F.col("fields_total"), 4)).drop("__v", "__same")
