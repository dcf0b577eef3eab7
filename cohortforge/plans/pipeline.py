"""End-to-end plans: chart features over all bins and the final assembly.

The chart features share one cleaned and de-duplicated event set. With
``materialize_events=True`` building the plan writes it once, as narrow Parquet
in the shared folder; otherwise the plan stays lazy and Spark reuses the
identical exchanges.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortforge.functions import contains_any_ci, contains_cs_any, hash_bin
from cohortforge.operators import features as fx
from cohortforge.operators.joins import merge_features
from cohortforge.plans import presets as P
from cohortforge.session import discard, materialize


def chart_item_filter(words: Sequence[str] = ("creatin", "hematocrit", "systolic", "diastolic"),
                      case_sensitive: Sequence[str] = P.BLOOD_PH["label_any"]) -> Column:
    """Union of the label predicates of the chart features: the dictionary is
    filtered by it before the event join."""
    return contains_any_ci(F.col("label"), words) | contains_cs_any(F.col("label"), case_sensitive)


# What the chart features read of an event.
CHART_COLUMNS = ("subject_id", "hadm_id", "itemid", "eventtime", "valuenum", "label", "row_order")


def with_row_order(charts: DataFrame, order: str | None = None) -> DataFrame:
    """Events with the file order as ``row_order``: the given column, else
    ``row_order`` itself, else the number in ``row_id``."""
    name = order or ("row_order" if "row_order" in charts.columns else "row_id")
    if name == "row_order":
        return charts
    col = F.col(name)
    return charts.withColumn("row_order", col.try_cast("bigint") if charts.schema[name].dataType.simpleString() == "string" else col)


def clean_chart_events(charts: DataFrame, items: DataFrame, label: DataFrame | None, bins: Sequence[str] | None = None,
                       item_filter: Column | None = None, key: str = "hadm_id",
                       max_rows_per_bin: int | None = None, order: str | None = None,
                       columns: Sequence[str] | None = None) -> DataFrame:
    """Cleaned, de-duplicated chart events, with the label columns where a label
    frame is given (one row per (subject, entity), joined after de-duplication);
    only the given ``columns`` enter the de-duplication."""
    charts = with_row_order(charts, order)
    if bins is not None:
        charts = charts.where(hash_bin(F.col(key)).isin(list(bins)))
    if max_rows_per_bin is not None:  # optional cap: first n rows of each bin in file order
        from cohortforge.operators.windows import first_n_in_order
        charts = first_n_in_order(charts.withColumn("__bin", hash_bin(F.col(key))), "__bin", "row_order",
                                  max_rows_per_bin).drop("__bin")
    ev = fx.clean_events(charts, items, None, item_filter=item_filter)
    ev = fx.dedupe_events(ev if columns is None else ev.select(*[c for c in columns if c in ev.columns]))
    return ev if label is None else ev.join(label, on=["subject_id", key], how="left")


def chart_features(charts: DataFrame, items: DataFrame, label: DataFrame, demographics: DataFrame,
                   bins: Sequence[str] | None = None, use_item_filter: bool = True,
                   materialize_events: bool = True, max_rows_per_bin: int | None = None,
                   order: str | None = None, write: bool = False) -> DataFrame:
    """Creatinine, hematocrit, blood pressure and blood pH features, merged:
    all hash bins in one job (``bins`` restricts to some bins). The admission time,
    all that the features need of the label frame, joins the reduced rows of an
    entity, never the events. ``write``: see :func:`merge_features`; the written events
    go when the features are."""
    ev = clean_chart_events(charts, items, None, bins, chart_item_filter() if use_item_filter else None,
                            max_rows_per_bin=max_rows_per_bin, order=order, columns=CHART_COLUMNS)
    if materialize_events:
        ev = materialize(ev, "chart-events")
    creat = fx.serial_change(ev, **P.CREATININE)
    hema = fx.group_reference_range(ev, demographics, **P.HEMATOCRIT)
    bp = fx.paired_reading_bands(ev, exclude=P.PRESSURE_EXCLUDE, hours=P.PRESSURE_WINDOW_HOURS, anchors=label)
    ph = fx.low_value_windows(ev, **P.BLOOD_PH, anchors=label)
    out = merge_features([creat, hema, bp, ph], write=write)
    if materialize_events and write:
        discard(ev)
    return out


def assemble_features(t: Mapping[str, DataFrame], label_code: str = P.LABEL_CATEGORY,
                      drug_groups: Mapping[str, Sequence[str]] = P.DRUG_GROUPS,
                      drug_hours: Sequence[float] = P.DRUG_WINDOW_HOURS,
                      contrast_codes: Sequence[str] = P.CONTRAST_CODES,
                      ventilation: tuple[str, str] = (P.VENTILATION_CODE, P.VENTILATION_TEXT),
                      comorbidities: Mapping[str, str] = P.COMORBIDITIES,
                      labs: Mapping[str, dict] = P.LABS, chart_bins: Sequence[str] | None = None,
                      chart_order: str | None = None) -> DataFrame:
    """The full feature set: label, demographics, chart features, category
    features, other visits, keyword groups, procedure flags and lab flags,
    merged on the entity in one shuffle. The label and each feature frame are written,
    so that the job's shuffle files are those of one frame at a time.

    ``t`` holds the role tables: admissions, patients, icustays, diagnoses,
    crosswalk, chartevents, d_items, prescriptions, cptevents, labevents,
    d_labitems. Tables may be all text, as read from CSV; ``chart_order`` names
    the column that holds the chart events' file order."""
    label = fx.category_label(t["diagnoses"], t["crosswalk"], t["admissions"], label_code=label_code)
    label = materialize(label, "label")  # read by the chart features too
    demo = fx.demographics(t["admissions"], t["patients"])
    gender = fx.gender_frame(t["admissions"], t["patients"])  # all the range features need
    charts = chart_features(t["chartevents"], t["d_items"], label, gender, bins=chart_bins, order=chart_order, write=True)
    onehot = fx.category_onehot(t["diagnoses"], t["crosswalk"], values=list(comorbidities))
    cats = [fx.category_columns(onehot, comorbidities)]
    prior = fx.other_visits_within_days(t["admissions"], t["icustays"])
    drugs = fx.keyword_group_windows(t["prescriptions"], t["admissions"], drug_groups, drug_hours)
    procs = fx.code_flags(t["cptevents"], {"ft_contrast_imaging": contrast_codes},
                          {"ft_mechanical_ventilation": ventilation})
    lab = fx.prepare_labs(t["labevents"], t["d_labitems"])
    lab_flags = fx.threshold_flags(lab, labs)
    base = label.drop("subject_id", "admittime", "dischtime")
    # lab flags of entities without any reading of that test stay null, as
    # with one frame per test; entities with no matching test are dropped
    lab_flags = lab_flags.where(F.coalesce(*[F.col(c).cast("int") for c in labs]).isNotNull())
    return merge_features([base, demo, charts, *cats, prior, drugs, procs, lab_flags], write=True)
