"""File-name fields, name clean-up and vehicle labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Patterns of the trip file names.
TRIP_FILE_PATTERN = r"(\d+)__(.*?)\.csv"
USER_PATTERN = r"(__.+)"
SEGMENT_PATTERN = r"(.*?)__"
UNSAFE_PATTERN = r"\s|\.|\(|\)"

# The vehicle labels that trips are tagged with.
VEHICLE_LABELS = [
    "CHEVROLET_BOLT_EUV_2022",
    "CHEVROLET_MALIBU_2022",
    "CHEVROLET_EQUINOX_2022",
    "CHEVROLET_SILVERADO_1500",
    "CHRYSLER_PACIFICA_HYBRID_2019",
    "FORD_MUSTANG",
    "FORD_F-150",
    "FORD_EXPLORER",
    "HONDA_ACCORD_2018",
    "HONDA_ACCORD_HYBRID_2018",
    "HONDA_CIVIC_2016",
    "HONDA_CIVIC_2022",
    "HONDA_PILOT_2017",
    "HYUNDAI_IONIQ_5_2022",
    "HYUNDAI_IONIQ_PHEV_2020",
    "HYUNDAI_KONA_ELECTRIC_2019",
    "HYUNDAI_PALISADE_2020",
    "HYUNDAI_SANTA_FE_2019",
    "HYUNDAI_SANTA_FE_HYBRID_2022",
    "HYUNDAI_SONATA_2020",
    "KIA_EV6_2022",
    "KIA_NIRO_EV_2020",
    "LEXUS_ES_2016",
    "LEXUS_RX_2016",
    "LEXUS_RX_2020",
    "RAM_1500_5TH_GEN",
    "TOYOTA_CAMRY_HYBRID_2021",
    "TOYOTA_COROLLA_HYBRID_TSS2_2019",
    "TOYOTA_COROLLA_TSS2_2019",
    "TOYOTA_HIGHLANDER_2020",
    "TOYOTA_PRIUS_2017",
    "TOYOTA_PRIUS_2017-20",
    "TOYOTA_PRIUS_v_2017",
    "TOYOTA_RAV4_2019",
    "TOYOTA_RAV4_HYBRID_2019",
    "VOLKSWAGEN_GOLF_7TH_GEN",
    "VOLKSWAGEN_PASSAT_2022",
    "VOLKSWAGEN_TIGUAN_2022",
    "VOLKSWAGEN_ATLAS_CROSS_SPORT",
]


def trip_id(file_name: Column) -> Column:
    """Digits before the first ``__``; null if the name has another form."""
    return F.nullif(F.regexp_extract(file_name, TRIP_FILE_PATTERN, 1), F.lit(""))


def trip_user(file_name: Column) -> Column:
    """Everything from the first ``__`` of the second field on, without ``__``; null if there is none."""
    rest = F.regexp_extract(file_name, TRIP_FILE_PATTERN, 2)
    return F.nullif(F.replace(F.regexp_extract(rest, USER_PATTERN, 1), F.lit("__"), F.lit("")), F.lit(""))


def trip_user_or_name(file_name: Column) -> Column:
    """Fallback rule: the last part that ends in ``__``, else the whole second field."""
    rest = F.nullif(F.regexp_extract(file_name, TRIP_FILE_PATTERN, 2), F.lit(""))
    return F.coalesce(F.try_element_at(F.regexp_extract_all(rest, F.lit(SEGMENT_PATTERN), 1), F.lit(-1)), rest)


def sanitize(name: Column) -> Column:
    """White space, dots and brackets become ``_``."""
    return F.regexp_replace(name, UNSAFE_PATTERN, "_")


def vehicle_make(label: Column) -> Column:
    return F.split_part(F.lower(label), F.lit("_"), F.lit(1))


def vehicle_model(label: Column) -> Column:
    return F.split_part(F.lower(label), F.lit("_"), F.lit(2))


def first_word(text: Column) -> Column:
    return F.split_part(text, F.lit(" "), F.lit(1))


def assign_label(key: Column, labels: list[str] = VEHICLE_LABELS, seed: int = 7919) -> Column:
    """A label picked by a whole-number key: the same key always gets the same label."""
    count = F.lit(len(labels))
    position = F.pmod(F.pmod(key, count) * F.lit(seed), count) + F.lit(1)
    return F.element_at(F.array(*[F.lit(label) for label in labels]), position.cast("int"))
