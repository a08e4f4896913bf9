"""Messages as objects of any shape: what they hold beside the fields of a frame, and
fields in other types than a frame's."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameweir.operators.parse import value_to_text
from frameweir.schema import FRAME_FIELDS, FRAME_SCHEMA


def parse_objects(records: DataFrame) -> DataFrame:
    """Every record with the fields of a frame, `extra` and `reason`.

    A message is read without a schema. A field of another type is taken where
    its value can be turned into the frame's (a number in quotes, a number for
    a text); `extra` names what else the object holds, sorted. The reason is
    null where all fields are there, else `empty`, `malformed` (no JSON, or a
    name that is there twice), `no object`, `missing field` (or a null one) or
    `other type`. `body` keeps the object as a variant, for later types.

    The text is parsed once into the variant; its names come from a look at the
    outermost level only.
    """
    texts = value_to_text(records)
    kept = [name for name in texts.columns if name != "message"]
    body = F.try_parse_json("message")
    # Exploded, so that later filters are not pushed below the parse and run it again.
    parsed = texts.select(*kept, "message", F.explode(F.array(body)).alias("body"))
    names = F.when(F.col("body").isNotNull(), F.json_object_keys("message"))
    parsed = parsed.withColumn("names", names)

    present, typed = F.lit(True), F.lit(True)
    fields = []
    for field in FRAME_SCHEMA:
        value = F.try_variant_get("body", f"$.{field.name}", field.dataType.simpleString())
        fields.append(F.when(F.col("names").isNotNull(), value).alias(field.name))
        there = F.try_variant_get("body", f"$.{field.name}", "variant")
        present = present & there.isNotNull() & ~F.coalesce(F.is_variant_null(there), F.lit(True))
        typed = typed & value.isNotNull()
    blank = F.col("message").isNull() | (F.trim("message") == "")
    reason = (
        F.when(blank, "empty")
        .when(F.col("body").isNull(), "malformed")
        .when(F.col("names").isNull(), "no object")
        .when(~F.coalesce(present, F.lit(False)), "missing field")
        .when(~typed, "other type")
    )
    others = F.sort_array(F.array_except("names", F.array(*[F.lit(x) for x in FRAME_FIELDS])))
    return parsed.select(*kept, *fields, others.alias("extra"), reason.alias("reason"), "body")
