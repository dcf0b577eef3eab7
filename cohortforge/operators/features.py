"""Composite feature operators: event tables in, one row per entity out.

All operators are parametric (column names, code lists, thresholds, windows);
the clinical values live in ``cohortforge.plans.presets``. Every predicate
that becomes a flag is two-valued: a missing value compares False.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from cohortforge.functions import (contains_ci, contains_cs_any, flag, hours_interval, normalize_category,
                                   normalize_ethnicity, strip_brackets, tolerant_double, tolerant_timestamp,
                                   truthy, wall_micros, whole_days, within_hours)
from cohortforge.operators.aggregates import discover_values, onehot_max_exprs, packed_or, unpacked
from cohortforge.operators.joins import anti_lookup, broadcast_if_small, lookup_join
from cohortforge.operators.windows import (HOT_SLOT_ROWS, NULL_BUCKET, dedupe_first, hour_bucket, order_key,
                                           previous_values, running_aggregates, second_of_slot, tie_fields)
from cohortforge.plans import presets as P
from cohortforge.session import materialize

KEY = "hadm_id"
SUBJECT = "subject_id"


def _ts(df: DataFrame, c: str, strict: bool = False) -> Column:
    """Column as timestamp_ntz; text is parsed (tolerant unless strict)."""
    dt = df.schema[c].dataType
    if isinstance(dt, TimestampNTZType):
        return F.col(c)
    if isinstance(dt, TimestampType):
        return F.col(c).cast("timestamp_ntz")
    if strict:
        return F.to_timestamp(F.col(c)).cast("timestamp_ntz")
    return tolerant_timestamp(F.col(c))


def _num(df: DataFrame, c: str) -> Column:
    return tolerant_double(F.col(c))


def _excluding(label: Column, words: Sequence[str]) -> Column:
    cond = F.lit(True)
    for w in words:
        cond = cond & ~contains_ci(label, w)
    return cond


# ------------------------------------------------------------------ label (F-1, F-7, F-8, F-21, F-22)
def map_codes(diagnoses: DataFrame, crosswalk: DataFrame, code_col: str = "icd9_code", map_key: str = "icd",
              validate: bool = True, indicator: str | None = "_hcc_merge") -> DataFrame:
    """Events joined to a code -> category map (m:1, checked)."""
    return lookup_join(diagnoses, crosswalk, code_col, map_key, how="left", indicator=indicator,
                       validate_m1=validate)


def category_label(diagnoses: DataFrame, crosswalk: DataFrame, admissions: DataFrame, label_code: str = "135",
                   category_col: str = "hcc", prefix: str = "hcc_cd", code_col: str = "icd9_code",
                   map_key: str = "icd", keys: Sequence[str] = (KEY, SUBJECT),
                   times: Sequence[str] = ("admittime", "dischtime"), validate: bool = True) -> DataFrame:
    """Label frame: per (entity, subject) 1 if any code maps to the label
    category, else 0 (unmapped codes give 0); then the admission times. Only
    one category survives, so this is a conditional max, not a pivot."""
    merged = map_codes(diagnoses, crosswalk, code_col, map_key, validate, indicator=None)
    keys = list(keys)
    label = (merged.where(F.col(keys[0]).isNotNull() & F.col(keys[1]).isNotNull())
             .groupBy(*keys).agg(F.max(flag(F.col(category_col) == F.lit(label_code))).alias(f"{prefix}_{label_code}")))
    adm = admissions.select(*keys, *[_ts(admissions, t).alias(t) for t in times])
    return label.join(adm, on=keys, how="left")


def category_onehot(diagnoses: DataFrame, crosswalk: DataFrame, values: Sequence[str] | None = None,
                    category_col: str = "hcc", prefix: str = "hcc_cd", code_col: str = "icd9_code",
                    map_key: str = "icd", keys: Sequence[str] = (KEY, SUBJECT), validate: bool = True) -> DataFrame:
    """All categories one-hot, max per (entity, subject)."""
    merged = map_codes(diagnoses, crosswalk, code_col, map_key, validate, indicator=None)
    if values is None:
        values = discover_values(crosswalk, category_col)
    keys = list(keys)
    return (merged.where(F.col(keys[0]).isNotNull() & F.col(keys[1]).isNotNull())
            .groupBy(*keys).agg(*onehot_max_exprs(F.col(category_col), values, prefix)))


def category_select(onehot: DataFrame, code: str = "", rename_as: str | None = None,
                    prefix: str = "hcc_cd", drop: Sequence[str] = (SUBJECT,), match: str = "exact") -> DataFrame:
    """Keep exactly one category column (or all when no code), optionally
    renamed; drop the subject column.

    ``match="contains"`` is the older substring form (F-7V): ``code`` is a
    text piece such as ``"_1"`` and every category column containing it is
    kept (``_1`` also keeps ``_19``); the column ``prefix + code`` is the one
    renamed. Only the column list changes, so the plan is a projection."""
    if rename_as is not None and not isinstance(rename_as, str):
        raise TypeError("rename_as must be a string")
    if match not in ("exact", "contains"):
        raise ValueError(f"match must be 'exact' or 'contains', not {match!r}")
    target = f"{prefix}_{code}" if match == "exact" else f"{prefix}{code}"
    keep = []
    for c in onehot.columns:
        if c in drop:
            continue
        if c.startswith(prefix + "_") and code and (c != target if match == "exact" else code not in c):
            continue
        keep.append(F.col(c).alias(rename_as) if (rename_as and code and c == target) else F.col(c))
    return onehot.select(*keep)


def category_columns(onehot: DataFrame, names: Mapping[str, str], prefix: str = "hcc_cd",
                     key: str = KEY) -> DataFrame:
    """Several categories at once, each renamed: one aggregation feeds them all."""
    return onehot.select(key, *[F.col(f"{prefix}_{code}").alias(name) for code, name in names.items()])


def unmapped_codes(diagnoses: DataFrame, crosswalk: DataFrame, titles: DataFrame, code_col: str = "icd9_code",
                   map_key: str = "icd", title_col: str = "short_title") -> DataFrame:
    """Codes without a category, joined to their titles, counted by title."""
    left_only = anti_lookup(diagnoses, crosswalk, code_col, map_key)
    t = broadcast_if_small(titles.select(F.col(code_col).alias("__c"), title_col))
    named = left_only.join(t, left_only[code_col] == t["__c"], "left")
    return named.where(F.col(title_col).isNotNull()).groupBy(title_col).agg(F.count(F.lit(1)).alias("n"))


# ----------------------------------------------------------------------------- charts (F-2)
CHART_DROP = ("conceptid", "param_type", "_d_items", "valueuom", "warning", "error", "resultstatus", "stopped",
              "row_id_x", "row_id_y", "linksto")


def clean_events(charts: DataFrame, items: DataFrame, label: DataFrame | None = None,
                 item_filter: Column | None = None, drop_cols: Sequence[str] = CHART_DROP,
                 indicator: str = "_d_items", keys: Sequence[str] = (SUBJECT, KEY)) -> DataFrame:
    """Events joined to the item dictionary, times parsed, earliest of chart
    and store time as ``eventtime``, numeric value parsed, category
    normalised, then the label frame joined on (subject, entity).

    ``item_filter`` (a predicate on dictionary columns) restricts the
    dictionary *before* the join; the join then becomes an inner join and the
    events of other items never leave the scan stage. Columns that both tables
    have (such as ``row_id``) are those of the events."""
    items = items.drop(*[c for c in items.columns if c != "itemid" and c in charts.columns])
    if item_filter is not None:
        dim = items.where(item_filter)
        ev = lookup_join(charts, dim, "itemid", how="inner")
    else:
        ev = lookup_join(charts, items, "itemid", how="left", indicator=indicator)
    ev = (ev.withColumn("charttime", _ts(ev, "charttime"))
            .withColumn("storetime", _ts(ev, "storetime")))
    ev = ev.withColumn("eventtime", F.least("charttime", "storetime"))
    ev = ev.withColumn("valuenum", _num(ev, "valuenum"))
    ev = ev.drop(*[c for c in drop_cols if c in ev.columns])
    if "category" in ev.columns:
        ev = ev.withColumn("category", normalize_category(F.col("category")))
    if label is not None:
        ev = ev.join(label, on=list(keys), how="left")
    return ev


def dedupe_events(events: DataFrame, keys: Sequence[str] = (KEY, "itemid", "eventtime"),
                  order: str = "row_order") -> DataFrame:
    """One reading per (entity, item, instant): the first in file order."""
    return dedupe_first(events, list(keys), order)


# ---------------------------------------------------------------- procedure codes (F-3, F-3V, F-18)
def code_list_flag(events: DataFrame, codes: Sequence[str], name: str = "ft_contrast_imaging",
                   code_col: str = "cpt_cd", key: str = KEY) -> DataFrame:
    return (events.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.max(flag(F.col(code_col).isin(list(dict.fromkeys(codes))))).alias(name)))


def code_prefix_flag(events: DataFrame, prefixes: Sequence[str], codes: Sequence[str],
                     name: str = "ft_contrast_imaging", code_col: str = "cpt_cd", key: str = KEY) -> DataFrame:
    """Older form: entities without any code of the prefixes are absent."""
    cond = F.lit(False)
    for p in prefixes:
        cond = cond | F.col(code_col).startswith(p)
    return code_list_flag(events.where(truthy(cond)), codes, name, code_col, key)


def code_and_text_flag(events: DataFrame, code: str, text: str, name: str = "ft_mechanical_ventilation",
                       code_col: str = "cpt_cd", text_col: str = "description", key: str = KEY) -> DataFrame:
    cond = truthy(F.col(code_col) == F.lit(code)) & contains_ci(F.col(text_col), text)
    return events.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(cond.cast("int")).alias(name))


# --------------------------------------------------------------------- keyword groups (F-4)
def keyword_group_windows(events: DataFrame, admissions: DataFrame, groups: Mapping[str, Sequence[str]],
                          hours: Sequence[float] = (24, 48, 72), text_col: str = "drug",
                          time_col: str = "startdate", anchor_col: str = "admittime",
                          name: str = "nephrotoxin", key: str = KEY, subject: str = SUBJECT,
                          strict_times: bool = False) -> DataFrame:
    """Flags per keyword, per keyword group and for any keyword, each also
    within x hours of the anchor time; max per entity, in one aggregation.

    "Some hit within x hours of the anchor" is "the earliest hit is", so the events
    are reduced to one row per (entity, subject) with a flag and the earliest time
    of each keyword, combined before the shuffle; the admission is joined to those
    rows (an admission is one row per entity; another subject's has no anchor)."""
    text = F.lower(F.col(text_col))
    words = list(dict.fromkeys(w for ws in groups.values() for w in ws))
    hit, first = {w: f"__w{i}" for i, w in enumerate(words)}, {w: f"__t{i}" for i, w in enumerate(words)}
    hits = list(hit.values())
    # each keyword test is evaluated once per row in a projection
    rows = events.where(F.col(key).isNotNull()).select(
        key, subject, _ts(events, time_col, strict_times).alias("__start"),
        *[truthy(text.contains(F.lit(w.lower()))).alias(c) for w, c in hit.items()])
    per = rows.groupBy(key, subject).agg(*packed_or(hits, "__p"),
                                         *[F.min(F.when(F.col(hit[w]), F.col("__start"))).alias(c) for w, c in first.items()])
    per = per.select(key, subject, *unpacked(hits, "__p", as_bool=True), *first.values())
    adm = admissions.select(F.col(key).alias("__k"), F.col(subject).alias("__s"),
                            _ts(admissions, anchor_col, strict_times).alias("__anchor"))
    per = per.join(adm, per[key] == adm["__k"], "left")
    anchor = F.when(F.col(subject) == F.col("__s"), F.col("__anchor"))

    def flags(label: str, ws: Sequence[str]) -> list[Column]:
        any_hit = F.greatest(*[F.col(hit[w]) for w in ws]) if len(ws) > 1 else F.col(hit[ws[0]])
        earliest = F.least(*[F.col(first[w]) for w in ws]) if len(ws) > 1 else F.col(first[ws[0]])
        return [any_hit.alias(label),
                *[within_hours(earliest, anchor, h).alias(f"{label}_within_{_h(h)}") for h in hours]]

    found = flags(f"ft_any_{name}_rx", words)
    labels = [f"ft_any_{name}_rx"]
    for group, ws in groups.items():
        ws = list(dict.fromkeys(ws))
        for w in ws:
            found += flags(f"ft_{name}_{w}_rx", [w])
            labels.append(f"ft_{name}_{w}_rx")
        found += flags(f"ft_{name}_{group}_rx", ws)
        labels.append(f"ft_{name}_{group}_rx")
    cols = [c for label in labels for c in (label, *[f"{label}_within_{_h(h)}" for h in hours])]
    at = [f"__f{i}" for i in range(len(cols))]  # a word may be named like its group
    per = per.select(key, *[c.alias(a) for c, a in zip(found, at)])
    return per.groupBy(key).agg(*packed_or(at, "__p")).select(key, *[c.alias(n) for c, n in zip(unpacked(at, "__p"), cols)])


def _h(h: float) -> str:
    return str(int(h)) if float(h).is_integer() else str(h)


# -------------------------------------------------------------------- other visits (F-5)
def other_visits_within_days(admissions: DataFrame, stays: DataFrame, days: Sequence[int] = (30, 60, 90, 120),
                             unit_days: int = 30, units: Sequence[str] = ("micu", "ccu"),
                             key: str = KEY, subject: str = SUBJECT, unit_col: str = "last_careunit",
                             los_col: str = "los", prefix: str = "prior_admission",
                             bucket_hours: int = 24, hot_rows: int = HOT_SLOT_ROWS,
                             direction: str = "any") -> DataFrame:
    """For each admission A, over the subject's *other* admissions B:
    ``ft_{prefix}_N`` = some B has ``whole_days(B.admit - A.disch) < N``; for
    ``unit_days`` also the max ICU length of stay of such B and flags for B's
    care units. Subjects with one admission are absent.

    ``direction="any"`` is the original rule, under which every earlier
    admission and later ones within N days count. ``direction="prior"``
    counts only B admitted strictly before A and discharged less than N days
    before A's admission (``A.admit - B.disch < N days``); see ``_prior_visits``.

    ``whole_days(x) < N`` equals ``x < N days``, so each (A, N) is an as-of
    question "which B were admitted before A.disch + N days". Instead of the
    all-pairs self-join, admissions (events) and thresholds (markers) are put
    in one time order per subject and answered with running aggregates:
    counts subtract A itself; for the maximum, A is left out exactly by a
    bitwise split of positions (every B differs from A in some bit of its
    position, A never does). Output work is linear in the admissions."""
    adm = admissions.select(F.col(key).alias("h"), F.col(subject).alias("s"),
                            _ts(admissions, "admittime").alias("admit"),
                            _ts(admissions, "dischtime").alias("disch")).where(F.col("s").isNotNull())
    st = (stays.groupBy(F.col(key).alias("h"))
          .agg(F.max(tolerant_double(F.col(los_col))).alias("los"),
               *[F.max(flag(F.lower(F.col(unit_col)) == F.lit(u))).alias(f"u_{u}") for u in units]))
    b = adm.join(st, "h", "left")
    n_sub = materialize(adm.groupBy(F.col("s").alias("__s")).agg(F.count(F.lit(1)).alias("n_sub")), "visit-counts")
    b = b.join(n_sub, b["s"] == n_sub["__s"], "left").drop("__s")
    # identity of an admission inside its subject: its position in (admit, id)
    # order, a running count (two-level, no whole-subject window); only
    # bit_length(max admissions per subject) bits are needed to exclude A
    if direction not in ("any", "prior"):
        raise ValueError(f"direction must be 'any' or 'prior', not {direction!r}")
    prior_maxes = {}
    if direction == "prior":
        # prefix maxima of discharge (all, and per care unit) in admission order
        has_admit = F.col("admit").isNotNull()
        prior_maxes["md"] = F.when(has_admit, F.col("disch"))
        for u in units:
            prior_maxes[f"md_{u}"] = F.when(has_admit & (F.col(f"u_{u}") == 1), F.col("disch"))
    b = running_aggregates(b, "s", hour_bucket(F.col("admit"), bucket_hours), [F.col("admit"), F.col("h")],
                           {"pos": F.lit(1)}, prior_maxes, split=second_of_slot(F.col("admit"), bucket_hours),
                           hot_rows=hot_rows, ties=tie_fields(b, "h"), most=F.col("n_sub"))
    b = materialize(b, "visits")  # the steps below read it several times
    nbits = max(1, int(n_sub.agg(F.max("n_sub")).first()[0] or 1).bit_length())
    if direction == "prior":
        return _prior_visits(b, days, unit_days, units, key, prefix, nbits, bucket_hours, hot_rows)
    b = b.select("*", *[F.coalesce(F.col(f"u_{u}"), F.lit(0)).alias(f"uu_{u}") for u in units])

    # one event row (the admission as a B) and one marker row per window N
    # (the admission as an A asking "B admitted before disch + N days")
    def row(t, kind, a, n, los, units_v, self_admit, self_units):
        return F.struct(t.alias("t"), F.lit(kind).alias("kind"), a.alias("a"), n.alias("n"), los.alias("los"),
                        *[v.alias(f"u_{u}") for u, v in zip(units, units_v)], self_admit.alias("self_admit"),
                        *[v.alias(f"self_u_{u}") for u, v in zip(units, self_units)])
    null_h = F.lit(None).cast(b.schema["h"].dataType)
    rows = [row(F.col("admit"), 1, null_h, F.lit(None).cast("int"), F.col("los"),
                [F.col(f"uu_{u}") for u in units], F.lit(None).cast("timestamp_ntz"),
                [F.lit(None).cast("int") for _ in units])]
    rows += [row(F.col("disch") + F.make_dt_interval(days=F.lit(int(n))), 0, F.col("h"), F.lit(int(n)),
                 F.lit(None).cast("double"), [F.lit(0) for _ in units], F.col("admit"),
                 [F.col(f"uu_{u}") for u in units]) for n in days]
    allrows = (b.select("s", "pos", "n_sub", F.inline(F.array(*rows)))
               .where(((F.col("kind") == 1) & F.col("t").isNotNull()) | ((F.col("kind") == 0) & (F.col("n_sub") >= 2))))

    # markers sort before events at the same instant: "admitted before T"
    is_ev = F.col("kind") == 1
    sums = {"cnt": F.when(is_ev, 1).otherwise(0)}
    for u in units:
        sums[f"cnt_{u}"] = F.when(is_ev, F.col(f"u_{u}")).otherwise(0)
    maxes = {}
    for j in range(nbits):
        bit = F.shiftright(F.col("pos"), j).bitwiseAND(1)
        for v in (0, 1):
            maxes[f"m{j}_{v}"] = F.when(is_ev & (bit == v), F.col("los"))
    run = running_aggregates(allrows, "s", hour_bucket(F.col("t"), bucket_hours), [F.col("t"), F.col("kind")],
                             sums, maxes, split=second_of_slot(F.col("t"), bucket_hours), hot_rows=hot_rows,
                             most=F.col("n_sub") * (len(days) + 1)) \
        .where(F.col("kind") == 0)

    valid_t = F.col("t").isNotNull()
    self_in = truthy(F.col("self_admit") < F.col("t")).cast("int")
    others = F.col("cnt") - self_in
    # the maximum over B != A: for each bit, take the running max of the
    # positions whose bit differs from A's; A itself never qualifies
    opp = [F.when(F.shiftright(F.col("pos"), j).bitwiseAND(1) == 1, F.col(f"m{j}_0")).otherwise(F.col(f"m{j}_1"))
           for j in range(nbits)]
    excl_max = F.greatest(*opp) if len(opp) > 1 else opp[0]
    per = run.select(
        F.col("a").alias(key), "n",
        flag(valid_t & (others > 0)).alias("prior"),
        F.when(valid_t, excl_max).alias("los_max"),
        *[flag(valid_t & ((F.col(f"cnt_{u}") - self_in * F.col(f"self_u_{u}")) > 0)).alias(f"unit_{u}")
          for u in units])
    aggs = [F.max(F.when(F.col("n") == n, F.col("prior"))).alias(f"ft_{prefix}_{n}") for n in days]
    aggs.append(F.max(F.when(F.col("n") == unit_days, F.col("los_max"))).alias(f"ft_avg_icu_los_within_{unit_days}"))
    aggs += [F.max(F.when(F.col("n") == unit_days, F.col(f"unit_{u}"))).alias(f"ft_{u}_within_{unit_days}")
             for u in units]
    return per.groupBy(key).agg(*aggs)


def _prior_visits(b: DataFrame, days: Sequence[int], unit_days: int, units: Sequence[str], key: str,
                  prefix: str, nbits: int, bucket_hours: int, hot_rows: int) -> DataFrame:
    """``direction="prior"`` of ``other_visits_within_days``. ``b`` holds one
    row per admission with its 1-based position ``pos`` in (admit, id) order
    (null admit last) and the prefix maxima of discharge ``md``/``md_{u}``.

    The B admitted strictly before A are positions 1..k, k = (first position
    of A's admit instant) - 1. "Some such B discharged after A.admit - N" is
    "max discharge over 1..k > A.admit - N": the prefix maximum at position k
    (a 1:1 join on (subject, position)). The longest stay of such B needs both
    conditions at once; positions 1..k split into at most ``nbits`` aligned
    blocks (one per set bit of k), and inside each block (subject, level,
    block) a descending as-of running max of los over discharge answers it.
    Rows grow by a factor of ``nbits`` = bit length of the largest admission
    count of a subject; no pairs are formed."""
    ma = [f"md_{u}" for u in units]
    a = b.where(F.col("n_sub") >= 2).select("h", "s", "admit", "n_sub")
    first = (b.where(F.col("admit").isNotNull()).groupBy("s", "admit")
             .agg((F.min("pos") - 1).alias("k")))
    a = a.join(first, ["s", "admit"], "left")
    at_k = b.select("s", F.col("pos").alias("k"), "md", *ma)
    a = materialize(a.join(at_k, ["s", "k"], "left"), "visit-places")

    # longest stay: events are B (discharge, los) in every level's block,
    # markers are A's blocks at instant A.admit - unit_days; time runs
    # backwards (negated micros), markers first at equal instants (strict >)
    p0 = F.col("pos") - 1
    ev = (b.where(F.col("admit").isNotNull() & F.col("disch").isNotNull() & F.col("los").isNotNull()
                  & (F.col("n_sub") >= 2))
          .select("s", "n_sub", (-wall_micros(F.col("disch"))).alias("tn"), F.lit(1).alias("kind"),
                  F.lit(None).cast(b.schema["h"].dataType).alias("a"), "los",
                  F.inline(F.array(*[F.struct(F.lit(j).alias("j"), F.shiftright(p0, j).alias("g"))
                                     for j in range(nbits)]))))
    k = F.col("k")
    mk = (a.where(k >= 1)
          .select("s", "n_sub", (-wall_micros(F.col("admit") - F.make_dt_interval(days=F.lit(int(unit_days))))).alias("tn"),
                  F.lit(0).alias("kind"), F.col("h").alias("a"), F.lit(None).cast("double").alias("los"),
                  F.inline(F.array(*[F.struct(F.lit(j).alias("j"), (F.shiftright(k, j) - 1).alias("g"),
                                              (F.shiftright(k, j).bitwiseAND(1) == 1).alias("on"))
                                     for j in range(nbits)])))
          .where(F.col("on")).drop("on"))
    rows = ev.unionByName(mk).withColumn("gk", F.struct("s", "j", "g"))
    width = bucket_hours * 3600
    slot = F.floor(F.col("tn") / F.lit(width * 1_000_000)).cast("bigint")
    split = (F.pmod(F.floor(F.col("tn") / F.lit(1_000_000)).cast("bigint"), F.lit(width)), width)
    run = running_aggregates(rows, "gk", F.coalesce(slot, F.lit(NULL_BUCKET).cast("bigint")),
                             [F.col("tn"), F.col("kind")], {}, {"lm": F.when(F.col("kind") == 1, F.col("los"))},
                             split=split, hot_rows=hot_rows, most=2 * F.col("n_sub"))  # a block's events and markers
    los = run.where(F.col("kind") == 0).groupBy(F.col("a").alias("h")).agg(F.max("lm").alias("los_max"))
    los = materialize(los, "visit-stays")

    a = a.join(los, "h", "left")

    def after(c, n):
        return flag(F.col(c) > F.col("admit") - F.make_dt_interval(days=F.lit(int(n))))
    aggs = [F.max(after("md", n)).alias(f"ft_{prefix}_{n}") for n in days]
    aggs.append(F.max("los_max").alias(f"ft_avg_icu_los_within_{unit_days}"))
    aggs += [F.max(after(f"md_{u}", unit_days)).alias(f"ft_{u}_within_{unit_days}") for u in units]
    return a.groupBy(F.col("h").alias(key)).agg(*aggs)


# ------------------------------------------------------------------------ labs (F-6, F-9..F-11)
LAB_COLUMNS = ("subject_id", "hadm_id", "charttime", "value", "valuenum", "valueuom", "label", "fluid",
               "category", "flag")


def prepare_labs(labevents: DataFrame, labitems: DataFrame, key: str = KEY) -> DataFrame:
    """Lab events with dictionary text (lower-cased), numeric value parsed,
    strict time parse, rows without an entity dropped."""
    j = lookup_join(labevents, labitems, "itemid", how="left")
    sel = []
    for c in LAB_COLUMNS:
        if c not in j.columns:
            sel.append(F.lit(None).cast("string").alias(c))
        elif c == "valuenum":
            sel.append(_num(j, c).alias(c))
        elif c in ("label", "fluid", "category"):
            sel.append(F.lower(F.col(c)).alias(c))
        elif c == "charttime":
            sel.append(_ts(j, c, strict=True).alias(c))
        else:
            sel.append(F.col(c))
    return j.select(*sel).where(F.col(key).isNotNull())


_OPS = {"<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b,
        ">=": lambda a, b: a >= b, "==": lambda a, b: a == b}


def threshold_flag(labs: DataFrame, name: str, op: str, cut: float, label_contains: str | None = None,
                   label_equals: str | None = None, fluid: str | None = "blood", as_bool: bool = False,
                   key: str = KEY) -> DataFrame:
    """Entity flag: any reading of the matching test beyond the cut."""
    cond = F.lit(True)
    if label_contains is not None:
        cond = cond & contains_ci(F.col("label"), label_contains)
    if label_equals is not None:
        cond = cond & truthy(F.col("label") == F.lit(label_equals))
    if fluid is not None:
        cond = cond & truthy(F.col("fluid") == F.lit(fluid))
    hit = truthy(_OPS[op](F.col("valuenum"), F.lit(cut)))
    v = hit if as_bool else hit.cast("int")
    return labs.where(cond).groupBy(key).agg(F.max(v).alias(name))


def code_flags(events: DataFrame, code_lists: Mapping[str, Sequence[str]] | None = None,
               code_texts: Mapping[str, tuple[str, str]] | None = None, code_col: str = "cpt_cd",
               text_col: str = "description", key: str = KEY) -> DataFrame:
    """Several procedure flags from one pass: code-list flags and
    code-and-text flags in a single aggregation."""
    aggs = [F.max(flag(F.col(code_col).isin(list(dict.fromkeys(codes))))).alias(name)
            for name, codes in (code_lists or {}).items()]
    aggs += [F.max((truthy(F.col(code_col) == F.lit(c)) & contains_ci(F.col(text_col), t)).cast("int")).alias(name)
             for name, (c, t) in (code_texts or {}).items()]
    return events.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)


def threshold_flags(labs: DataFrame, specs: Mapping[str, dict], key: str = KEY) -> DataFrame:
    """Several lab flags in one aggregation. Each flag keeps its own test
    filter as a condition, so an entity that has none of a test's readings
    gets null for that flag (absent), as with separate frames merged."""
    aggs = []
    for name, spec in specs.items():
        cond = F.lit(True)
        if spec.get("label_contains") is not None:
            cond = cond & contains_ci(F.col("label"), spec["label_contains"])
        if spec.get("label_equals") is not None:
            cond = cond & truthy(F.col("label") == F.lit(spec["label_equals"]))
        if spec.get("fluid", "blood") is not None:
            cond = cond & truthy(F.col("fluid") == F.lit(spec.get("fluid", "blood")))
        hit = truthy(_OPS[spec["op"]](F.col("valuenum"), F.lit(spec["cut"])))
        v = hit if spec.get("as_bool") else hit.cast("int")
        aggs.append(F.max(F.when(cond, v)).alias(name))
    return labs.groupBy(key).agg(*aggs)


# ------------------------------------------------------------------- chart features (F-12..F-17)
def low_value_windows(charts: DataFrame, name: str = "blood_ph", label_any: Sequence[str] = ("pH", "PH"),
                      cut: float = 7.30, hours: Sequence[float] = (6, 12, 24, 36, 48), masked: bool = False,
                      with_means: bool = True, key: str = KEY, anchors: DataFrame | None = None,
                      subject: str = SUBJECT) -> DataFrame:
    """Low-value flag, also within x hours of admission; a mean per flag
    (``masked=False`` reproduces the unmasked means) and the overall mean.

    ``anchors`` (entity, subject, admittime; one row each) serves events without an
    admission time: the earliest low reading decides every window, so the events
    are reduced first and the anchors joined to one row per (entity, subject).
    Masked means need the window of every reading, hence the time on the events."""
    res = charts.where(contains_cs_any(F.col("label"), label_any))
    v = F.col("valuenum")
    low = truthy(v < F.lit(cut))
    if anchors is not None:
        if masked:
            raise ValueError("masked means need the admission time on the events")
        per = res.where(F.col(key).isNotNull()).groupBy(key, subject).agg(
            F.max(low.cast("int")).alias("__low"), F.min(F.when(low, F.col("eventtime"))).alias("__first"),
            F.sum(v).alias("__sum"), F.count(v).alias("__n"))
        per = per.join(anchors.select(key, subject, "admittime"), [key, subject], "left")
        names = {f"ft_low_{name}": F.max("__low")}
        for h in hours:
            names[f"ft_low_{name}_within_{_h(h)}_hrs"] = F.max(within_hours(F.col("__first"), F.col("admittime"), h).cast("int"))
        mean = F.try_divide(F.sum("__sum"), F.sum("__n"))
        means = [mean.alias(k.replace("ft_", "ft_avg_", 1)) for k in names] + [mean.alias(f"ft_{name}")]
        return per.groupBy(key).agg(*[c.alias(k) for k, c in names.items()], *(means if with_means else []))
    flags = {f"ft_low_{name}": low}
    for h in hours:
        flags[f"ft_low_{name}_within_{_h(h)}_hrs"] = low & within_hours(F.col("eventtime"), F.col("admittime"), h)
    aggs = [F.max(c.cast("int")).alias(k) for k, c in flags.items()]
    if with_means:
        for k, c in flags.items():
            aggs.append(F.avg(F.when(c, v) if masked else v).alias(k.replace("ft_", "ft_avg_", 1)))
        aggs.append(F.avg(v).alias(f"ft_{name}"))
    return res.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)


def _rule(v: Column, rule) -> Column:
    op, a, b = rule
    if op == "between":
        return truthy(v.between(a, b))
    return truthy(_OPS[op](v, F.lit(a)))


def paired_reading_bands(charts: DataFrame, first: str = "systolic", second: str = "diastolic",
                         exclude: Sequence[str] = ("unloading", "pulmonary", "pap"),
                         bands: Mapping[str, tuple] = P.PRESSURE_BANDS, window_band: str = "ft_hbp_stg_2",
                         hours: Sequence[float] = (6, 12, 24, 36, 48), window_suffix: str = "hours",
                         key: str = KEY, anchors: DataFrame | None = None, subject: str = SUBJECT) -> DataFrame:
    """Bands over readings of two series taken at the same entity and instant.

    Each band is "first-rule AND/OR second-rule" maxed over all co-occurring
    pairs. Over the pairs of one (entity, instant) group such a max equals a
    combination of per-side existence flags, so each side is aggregated to
    one row per group first and the sides are joined 1:1 (null instants
    match each other). No pair is ever materialised.

    ``anchors`` (entity, subject, admittime; one row each) serves events without an
    admission time: the earliest instant at which the window band holds decides all
    windows, so the anchors are joined to one row per entity and subject. An
    entity's readings are taken to be of one subject."""
    def side(word: str) -> DataFrame:
        return charts.where(contains_ci(F.col("label"), word) & _excluding(F.col("label"), exclude)
                            & F.col(key).isNotNull())

    s, d = side(first), side(second)
    sv, dv = F.col("valuenum"), F.col("valuenum")
    s_aggs = [F.max(_rule(sv, r[0]).cast("int")).alias(f"s_{n}") for n, r in bands.items()]
    wr = bands[window_band][0] if window_band else None
    if anchors is not None:
        s_aggs.append(F.max(subject).alias(subject))
    for h in hours if window_band and anchors is None else ():
        w = within_hours(F.col("eventtime"), F.col("admittime"), h)
        s_aggs.append(F.max(w.cast("int")).alias(f"w_{_h(h)}"))
        s_aggs.append(F.max((w & _rule(sv, wr)).cast("int")).alias(f"pw_{_h(h)}"))
    # group on (entity, instant-or-sentinel, instant-is-null): null instants
    # meet each other, and the join keys equal the grouping keys, so both
    # aggregated sides stay co-partitioned for the join (no re-shuffle)
    tk = F.coalesce(F.col("eventtime"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    tn = F.col("eventtime").isNull()
    sa = s.groupBy(F.col(key), tk.alias("__tk"), tn.alias("__tn")).agg(*s_aggs)
    da = d.groupBy(F.col(key), tk.alias("__tk"), tn.alias("__tn")).agg(
        *[F.max(_rule(dv, r[1]).cast("int")).alias(f"d_{n}") for n, r in bands.items()])
    j = sa.join(da, [key, "__tk", "__tn"], "inner")
    out = []
    for n, (_, _, how) in bands.items():
        a, b = F.col(f"s_{n}"), F.col(f"d_{n}")
        out.append(F.max(F.least(a, b) if how == "and" else F.greatest(a, b)).alias(n))
    if anchors is not None and window_band:
        holds = (F.greatest(f"s_{window_band}", f"d_{window_band}") == 1) & ~F.col("__tn")
        per = j.groupBy(key, subject).agg(*out, F.min(F.when(holds, F.col("__tk"))).alias("__first"))
        per = per.join(anchors.select(key, subject, "admittime"), [key, subject], "left")
        return per.groupBy(key).agg(*[F.max(n).alias(n) for n in bands], *[
            F.max(within_hours(F.col("__first"), F.col("admittime"), h).cast("int")).alias(f"{window_band}_within_{_h(h)}_{window_suffix}")
            for h in hours])
    for h in hours if window_band else ():
        pw, w, q = F.col(f"pw_{_h(h)}"), F.col(f"w_{_h(h)}"), F.col(f"d_{window_band}")
        out.append(F.max(F.greatest(pw, F.least(w, q))).alias(f"{window_band}_within_{_h(h)}_{window_suffix}"))
    return j.groupBy(key).agg(*out)


def group_reference_range(charts: DataFrame, groups: DataFrame, name: str = "hematocrit",
                          exclude: Sequence[str] = ("apache",), group_col: str = "ft_gender", group_value=1,
                          in_group_range: tuple = (42, 50), other_range: tuple = (37, 47), very_low: float = 20,
                          key: str = KEY) -> DataFrame:
    """Above / below a reference range that depends on a group column (e.g.
    gender), and below a hard floor; mean value. An unknown group uses the
    other range (negation of a False match).

    "Some value above a limit" is "the largest value is", so the readings are reduced
    to one row per entity before the group is joined."""
    v = F.col("valuenum")
    per = charts.where(contains_ci(F.col("label"), name) & _excluding(F.col("label"), exclude)
                       & F.col(key).isNotNull()).groupBy(key).agg(F.avg(v).alias("__avg"), F.max(v).alias("__max"), F.min(v).alias("__min"))
    of_group = truthy(F.col(group_col) == F.lit(group_value))
    g = groups.groupBy(F.col(key).alias("__k")).agg(F.max(of_group).alias("__in"), F.max(~of_group).alias("__out"))
    j = per.join(g, per[key] == g["__k"], "left")
    ing, other = F.coalesce("__in", F.lit(False)), F.coalesce("__out", F.lit(True))
    above = (ing & truthy(F.col("__max") > in_group_range[1])) | (other & truthy(F.col("__max") > other_range[1]))
    below = (ing & truthy(F.col("__min") < in_group_range[0])) | (other & truthy(F.col("__min") < other_range[0]))
    return j.select(key, F.col("__avg").alias(f"ft_avg_{name}"), above.cast("int").alias(f"ft_above_normal_{name}"),
                    below.cast("int").alias(f"ft_below_normal_{name}"),
                    truthy(F.col("__min") < F.lit(very_low)).cast("int").alias(f"ft_way_below_normal_{name}"))


def _serial_rows(charts: DataFrame, match: str, max_value: float, order_tiebreak: str, key: str,
                 bucket_hours: int = 1, hot_rows: int = HOT_SLOT_ROWS) -> DataFrame:
    res = charts.where(contains_ci(F.col("label"), match) & truthy(F.col("valuenum") <= F.lit(max_value))
                       & F.col(key).isNotNull())
    res = res.select(key, "eventtime", "valuenum", order_tiebreak)
    prev = previous_values(res, key, hour_bucket(F.col("eventtime"), bucket_hours),
                           [F.col("eventtime"), F.col(order_tiebreak)], ["valuenum", "eventtime"],
                           split=second_of_slot(F.col("eventtime"), bucket_hours), hot_rows=hot_rows,
                           ties=tie_fields(res, order_tiebreak))
    return prev.select(key, "eventtime", "valuenum", order_tiebreak,
                       (F.col("valuenum") - F.col("prev_valuenum")).alias("delta"),
                       (F.col("eventtime") - F.col("prev_eventtime")).alias("delta_time"))


def serial_change(charts: DataFrame, name: str = "creatinine", match: str = "creatin", max_value: float = 11,
                  rise: float = 0.3, rise_hours: float = 48, ratio: float = 1.5, baseline_gt: float = 1,
                  with_baseline: bool = True, order_tiebreak: str = "row_order", key: str = KEY,
                  hot_rows: int = HOT_SLOT_ROWS) -> DataFrame:
    """Change against the previous reading (rise within x hours), against the
    first reading (baseline ratio), baseline level, mean value.

    The previous reading needs a window; the baseline is the first reading in
    time order (``min_by``) and "any reading >= ratio x baseline" equals
    "max reading >= ratio x baseline", so both are plain aggregates."""
    rows = _serial_rows(charts, match, max_value, order_tiebreak, key, hot_rows=hot_rows)
    rise_flag = truthy(F.col("delta") >= F.lit(rise)) & truthy(F.col("delta_time") <= hours_interval(rise_hours))
    g = rows.groupBy(key).agg(
        F.max(rise_flag.cast("int")).alias("__rise"),
        F.max("valuenum").alias("__max"),
        F.min_by("valuenum", order_key([F.col("eventtime"), F.col(order_tiebreak)])).alias("__base"),
        F.avg("valuenum").alias(f"ft_avg_{name}"))
    cols = [F.col(key),
            F.col("__rise").alias(f"ft_{name}_increase_within_{_h(rise_hours)}"),
            flag(F.col("__max") >= F.lit(ratio) * F.col("__base")).alias(f"ft_{name}_increase_from_baseline"),
            flag(F.col("__base") > F.lit(baseline_gt)).alias(f"ft_baseline_{name[:5]}_gt_{_h(baseline_gt)}")]
    if with_baseline:
        cols.append(F.col("__base").alias(f"ft_baseline_{name}"))
    cols.append(F.col(f"ft_avg_{name}"))
    return g.select(*cols)


def serial_change_audit(charts: DataFrame, name: str = "creatinine", match: str = "creatin",
                        max_value: float = 11, rise: float = 0.3, rise_hours: float = 48, ratio: float = 1.5,
                        baseline_gt: float = 1, order_tiebreak: str = "row_order", key: str = KEY,
                        hot_rows: int = HOT_SLOT_ROWS) -> DataFrame:
    """Row-level records of the entities that show a rise (audit output).
    The entity filter is an aggregate + join, not a whole-entity window. The rows with
    their changes are written once; one aggregation of them gives the baseline and
    whether the entity has a rise."""
    rows = materialize(_serial_rows(charts, match, max_value, order_tiebreak, key, hot_rows=hot_rows), "serial-rows")
    rise_flag = (truthy(F.col("delta") >= F.lit(rise)) & truthy(F.col("delta_time") <= hours_interval(rise_hours))).cast("int")
    hit = rows.groupBy(F.col(key).alias("__k")).agg(
        F.min_by("valuenum", order_key([F.col("eventtime"), F.col(order_tiebreak)])).alias("baseline"),
        F.max(rise_flag).alias("__m")).where(F.col("__m") == 1)
    j = rows.join(hit, rows[key] == hit["__k"], "inner")
    return j.select(key, "valuenum", "delta", _interval_hours(F.col("delta_time")).alias("delta_hours"), "baseline", rise_flag.alias(f"ft_{name}_increase_within_{_h(rise_hours)}"),
                 flag(F.col("valuenum") >= F.lit(ratio) * F.col("baseline")).alias(f"ft_{name}_increase_from_baseline"),
                 flag(F.col("baseline") > F.lit(baseline_gt)).alias(f"ft_baseline_{name[:5]}_gt_{_h(baseline_gt)}"))


def _interval_hours(iv: Column) -> Column:
    """Day-time interval -> hours as double."""
    return (F.extract(F.lit("DAY"), iv) * 24 + F.extract(F.lit("HOUR"), iv)
            + F.extract(F.lit("MINUTE"), iv) / 60 + F.extract(F.lit("SECOND"), iv) / 3600).cast("double")


def categorical_readings_onehot(charts: DataFrame, match: str = "urine",
                                specs: Sequence[tuple[str, str]] = (("Urine Color", "ft_urine_color"),
                                                                    ("Urine Appearance", "ft_urine_appearance")),
                                keep_prefix: str = "ft_", values: Mapping[str, Sequence[str]] | None = None,
                                key: str = KEY, how: str = "full") -> DataFrame:
    """One-hot of the lower-cased text value for each exact label, max per
    entity, sides outer-joined (``how="left"``: entities of the first side only). Each side is aggregated before the join (the
    max over a many-to-many join equals the per-side max). A prefix without
    ``keep_prefix`` keeps only its keys (parity with the dropped columns)."""
    res = charts.where(contains_ci(F.col("label"), match) & F.col(key).isNotNull()) \
        .withColumn("label", strip_brackets(F.col("label")))
    out = None
    for label, prefix in specs:
        side = res.where(truthy(F.col("label") == F.lit(label)))
        val = F.lower(F.col("value"))
        vals = (values or {}).get(label)
        if vals is None:
            vals = discover_values(side, val)
        if prefix.startswith(keep_prefix):
            agg = side.groupBy(key).agg(*onehot_max_exprs(val, vals, prefix)) if vals else side.select(key).distinct()
        else:
            agg = side.select(key).distinct()
        out = agg if out is None else out.join(agg, key, how)
    return out


def gender_frame(admissions: DataFrame, patients: DataFrame, gender_map: Mapping[str, int] | None = None,
                 key: str = KEY, subject: str = SUBJECT) -> DataFrame:
    """Per entity the 0/1 gender only (what reference ranges by gender need),
    without the one-hot columns of the full demographics."""
    gender_map = gender_map or {"F": 0, "M": 1}
    g = None
    for k, v in gender_map.items():
        g = F.when(F.col("gender") == F.lit(k), F.lit(v)) if g is None else g.when(F.col("gender") == F.lit(k), F.lit(v))
    pts = patients.select(F.col(subject).alias("__s"), "gender")
    pt = admissions.select(key, subject).join(pts, F.col(subject) == F.col("__s"), "left")
    return pt.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(g).alias("ft_gender"))


# --------------------------------------------------------------------------- demographics (F-13)
def demographics(admissions: DataFrame, patients: DataFrame, gender_map: Mapping[str, int] | None = None,
                 fold: Sequence[str] | None = P.UNKNOWN_ETHNICITY, fold_name: str = "ft_race_missing_info",
                 normalizer=normalize_ethnicity, type_values: Sequence[str] | None = None,
                 race_values: Sequence[str] | None = None, max_age_days: int = 106751,
                 key: str = KEY, subject: str = SUBJECT) -> DataFrame:
    """Gender as 0/1, age in years at admission (implausible ages null),
    one-hot admission type and normalised ethnicity with the unknown classes
    folded into one column; mean / first / max per entity."""
    gender_map = gender_map or {"F": 0, "M": 1}
    pts = patients.select(F.col(subject).alias("__s"), "gender", _ts(patients, "dob").alias("dob"))
    pt = admissions.join(pts, admissions[subject] == pts["__s"], "left")
    admit = _ts(admissions, "admittime")
    g = None
    for k, v in gender_map.items():
        g = F.when(F.col("gender") == F.lit(k), F.lit(v)) if g is None else g.when(F.col("gender") == F.lit(k), F.lit(v))
    days = whole_days(admit, F.col("dob"))
    age = days / F.lit(365.25)
    age = F.when((age >= -1) & (days <= max_age_days), age)
    atype = F.lower(F.col("admission_type"))
    race = normalizer(F.col("ethnicity"))
    pt = pt.select(key, g.alias("ft_gender"), age.alias("ft_age"), atype.alias("__type"), race.alias("__race"))
    if type_values is None:
        type_values = discover_values(pt, "__type")
    if race_values is None:
        race_values = discover_values(pt, "__race")
    race_cols = {f"ft_race_{v}": v for v in race_values}
    folded = [c for c in (fold or ()) if c in race_cols]
    aggs = [F.avg("ft_age").alias("ft_age"), F.max("ft_gender").alias("ft_gender")]
    aggs += onehot_max_exprs(F.col("__type"), type_values, "ft_admit_type")
    aggs += [F.max(flag(F.col("__race") == F.lit(v))).alias(c) for c, v in race_cols.items() if c not in folded]
    if fold is not None:
        fold_vals = [race_cols[c] for c in folded]
        aggs.append((F.max(flag(F.col("__race").isin(fold_vals))) if fold_vals else F.lit(None).cast("int"))
                    .alias(fold_name))
    return pt.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)
