"""Bulk scoring requests: defaults, validation, and the encoding shared with training."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendstrata.operators.application import app_features, fix_anomalies
from lendstrata.operators.encode import EncodingPlan
from lendstrata.operators.target import TargetEncoding
from lendstrata.sources.schemas import BUILDING_PARTS


@dataclass(frozen=True)
class Field:
    """One request field. Bounds only apply to present values."""

    type: str
    required: bool = False
    default: object = None
    gt: float | None = None
    ge: float | None = None
    lt: float | None = None
    le: float | None = None


def _optional(kind: str, *names: str) -> dict[str, Field]:
    return dict.fromkeys(names, Field(kind))


def _building(kind: str) -> dict[str, Field]:
    return _optional("double", *[f"{part}_{kind}" for part in BUILDING_PARTS])


# The request fields in order, with their rules and defaults.
REQUEST_FIELDS: dict[str, Field] = {
    "NAME_CONTRACT_TYPE": Field("string", required=True),
    "AMT_CREDIT": Field("double", required=True, gt=0),
    "AMT_INCOME_TOTAL": Field("double", required=True, gt=0),
    "AMT_ANNUITY": Field("double", gt=0),
    "AMT_GOODS_PRICE": Field("double", gt=0),
    "CODE_GENDER": Field("string", required=True),
    "FLAG_OWN_CAR": Field("string", required=True),
    "FLAG_OWN_REALTY": Field("string", required=True),
    "CNT_CHILDREN": Field("int", default=0, ge=0),
    "CNT_FAM_MEMBERS": Field("double", ge=1),
    "DAYS_BIRTH": Field("int", required=True, lt=0),
    "DAYS_EMPLOYED": Field("int"),
    "DAYS_REGISTRATION": Field("double"),
    "DAYS_ID_PUBLISH": Field("int"),
    "DAYS_LAST_PHONE_CHANGE": Field("double"),
    "NAME_INCOME_TYPE": Field("string", required=True),
    "OCCUPATION_TYPE": Field("string"),
    "ORGANIZATION_TYPE": Field("string"),
    "NAME_EDUCATION_TYPE": Field("string", required=True),
    "NAME_FAMILY_STATUS": Field("string", required=True),
    "NAME_HOUSING_TYPE": Field("string", required=True),
    "EXT_SOURCE_1": Field("double", ge=0, le=1),
    "EXT_SOURCE_2": Field("double", ge=0, le=1),
    "EXT_SOURCE_3": Field("double", ge=0, le=1),
    "REGION_RATING_CLIENT": Field("int", default=2, ge=1, le=3),
    "REGION_POPULATION_RELATIVE": Field("double"),
    "OWN_CAR_AGE": Field("double"),
    "HOUR_APPR_PROCESS_START": Field("int"),
    **_optional("int", "FLAG_MOBIL", "FLAG_EMP_PHONE", "FLAG_WORK_PHONE", "FLAG_CONT_MOBILE", "FLAG_PHONE", "FLAG_EMAIL"),
    **_optional("int", "REG_REGION_NOT_LIVE_REGION", "REG_REGION_NOT_WORK_REGION", "LIVE_REGION_NOT_WORK_REGION"),
    **_optional("int", "REG_CITY_NOT_LIVE_CITY", "REG_CITY_NOT_WORK_CITY", "LIVE_CITY_NOT_WORK_CITY"),
    **_building("AVG"),
    **_building("MODE"),
    **_building("MEDI"),
    "TOTALAREA_MODE": Field("double"),
    "EMERGENCYSTATE_MODE": Field("string"),
    **_optional("double", "OBS_30_CNT_SOCIAL_CIRCLE", "OBS_60_CNT_SOCIAL_CIRCLE"),
    **_optional("double", "DEF_30_CNT_SOCIAL_CIRCLE", "DEF_60_CNT_SOCIAL_CIRCLE"),
    **_optional("int", *[f"FLAG_DOCUMENT_{i}" for i in range(2, 22)]),
    **_optional("string", "WEEKDAY_APPR_PROCESS_START", "FONDKAPREMONT_MODE", "HOUSETYPE_MODE", "WALLSMATERIAL_MODE"),
}


def request_fields(feature_names: Iterable[str] = ()) -> dict[str, Field]:
    """All request fields; ready-made history features may be passed along as optional numbers."""
    return REQUEST_FIELDS | {c: Field("double") for c in feature_names if c not in REQUEST_FIELDS}


UNREADABLE = "request unreadable"


def raw_schema(fields: dict[str, Field], *ids: str) -> T.StructType:
    """Every field as its text, so that a value of the wrong type is seen; and the line if it can't be read."""
    return T.StructType([T.StructField(n, T.StringType()) for n in (*ids, *fields, UNREADABLE)])


TYPE_ERRORS = "type_errors"


def _typed(raw: Column, f: Field) -> Column:
    """The value in the field's type; missing if it has none. Whole numbers only for an int."""
    if f.type == "string":
        return raw.cast("string")
    number = raw.try_cast("double")
    return F.when(number == F.floor(number), number.try_cast("int")) if f.type == "int" else number


def apply_defaults(df: DataFrame, fields: dict[str, Field], keep: list[str] = ()) -> DataFrame:
    """Exactly the request fields: unknown columns go, absent ones are missing, defaults fill in.

    A present value that is not of the field's type becomes missing, and ``type_errors`` names the field.
    """
    given = {n: _typed(F.col(n), f) if n in df.columns else F.lit(None).cast(f.type) for n, f in fields.items()}
    wrong = [
        F.when(F.col(n).isNotNull() & given[n].isNull(), F.lit(n)) for n, f in fields.items() if n in df.columns and f.type != "string"
    ]
    errors = F.array_compact(F.array(*wrong)) if wrong else F.array().cast("array<string>")
    filled = {n: v if fields[n].default is None else F.coalesce(v, F.lit(fields[n].default).cast(fields[n].type)) for n, v in given.items()}
    return df.select(*keep, *[v.alias(n) for n, v in filled.items()], errors.alias(TYPE_ERRORS))


def _rules(name: str, f: Field, wrong: Column) -> list[Column]:
    """The failed rules of a field, each null if it is kept."""
    c = F.col(name)
    checks = [F.when(c.isNull() & ~wrong, F.lit(f"{name} missing"))] if f.required else []
    for bound, broken, sign in (
        (f.gt, lambda x, b: x <= b, ">"),
        (f.ge, lambda x, b: x < b, ">="),
        (f.lt, lambda x, b: x >= b, "<"),
        (f.le, lambda x, b: x > b, "<="),
    ):
        if bound is not None:
            checks.append(F.when(~wrong & broken(c, bound), F.lit(f"{name} {sign} {bound:g}")))
    return checks


def violations(fields: dict[str, Field], typed: bool = True) -> Column:
    """Array with the names of the failed rules, in field order; ``typed`` if the rows have ``type_errors``.

    Most fields have a type and no rule. A run of such fields takes its part of ``type_errors`` as it is, which has the fields' order.
    """
    parts: list[Column] = []
    for ruled, run in groupby(fields.items(), lambda x: bool(_rules(*x, F.lit(False)))):
        own = dict(run)
        names = [n for n, f in own.items() if f.type != "string"]
        if ruled:
            checks: list[Column] = []
            for name, f in own.items():
                wrong = F.array_contains(TYPE_ERRORS, name) if typed and name in names else F.lit(False)
                if typed and name in names:
                    checks.append(F.when(wrong, F.lit(f"{name} type")))
                checks += _rules(name, f, wrong)
            parts.append(F.array_compact(F.array(*checks)))
        elif typed and names:
            parts.append(F.transform(F.filter(TYPE_ERRORS, lambda x: x.isin(names)), lambda x: F.concat(x, F.lit(" type"))))
    return F.concat(*parts) if parts else F.array().cast("array<string>")


def validate_rules(df: DataFrame, fields: dict[str, Field]) -> DataFrame:
    """Add ``violations`` and ``valid``; split with ``where('valid')`` and ``where('not valid')``."""
    found = violations(fields, TYPE_ERRORS in df.columns)
    return df.withColumn("violations", found).withColumn("valid", F.size("violations") == 0).drop(TYPE_ERRORS)


def serving_features(
    requests: DataFrame, plan: EncodingPlan, feature_list: list[str], keep: list[str] = ()
) -> DataFrame:
    """Requests as the features a model was trained on, by the encoders fitted in training.

    A feature that is not derivable from the request is missing. High-cardinality texts stay text.
    """
    encoded = plan.transform(app_features(fix_anomalies(requests)))
    have = set(encoded.columns)
    return encoded.select(
        *keep, *[F.col(c) if c in have else F.lit(None).cast("double").alias(c) for c in feature_list]
    )


def serving_encode(
    requests: DataFrame,
    plan: EncodingPlan,
    feature_list: list[str],
    target_encoding: TargetEncoding | None = None,
    keep: list[str] = (),
) -> DataFrame:
    """The serving features as numbers only, high-cardinality texts by their target encoding."""
    features = serving_features(requests, plan, feature_list, keep)
    encoded = features if target_encoding is None else target_encoding.transform(features)
    return encoded.select(*keep, *[F.col(c).cast("double").alias(c) for c in feature_list])
