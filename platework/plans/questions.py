"""The named business questions. Each takes the tables by name and returns a DataFrame.

Tables: agg_by_year, agg_by_county, dim_vehicle, dim_geography, fact_registrations, silver, bronze, raw,
incentive_applications, state_goals, zip_demographics; a question reads only the ones it names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platework.functions.numbers import percent_double, sum_where
from platework.functions.times import days_between
from platework.operators.grouped import count_by, running_total, top_k, with_growth, with_share
from platework.operators.lookups import left_lookup

Tables = dict[str, DataFrame]

def _approved():
    return F.col("status") == "APPROVED"


def _count():
    return F.count(F.lit(1))


# Progress and trend

def goal_progress(t: Tables, since: int = 2020) -> DataFrame:
    rows = t["agg_by_year"].where(F.col("MODEL_YEAR") >= since)
    return rows.select(
        "MODEL_YEAR", "EV_TYPE", "REGISTRATION_COUNT", "CUMULATIVE_COUNT", "TARGET_EV_COUNT",
        F.round(F.col("PCT_OF_GOAL") * 100, 2).alias("pct_of_goal"),
    ).orderBy("MODEL_YEAR", "EV_TYPE")


def yearly_growth(t: Tables) -> DataFrame:
    totals = t["agg_by_year"].groupBy("MODEL_YEAR").agg(F.sum("REGISTRATION_COUNT").alias("total"))
    return with_growth(totals, "total", "MODEL_YEAR", "prev_year", "yoy_growth_pct").orderBy(
        F.col("MODEL_YEAR").asc_nulls_last()
    )


def biggest_jump(t: Tables) -> DataFrame:
    grown = yearly_growth(t).where(F.col("prev_year").isNotNull())
    jump = grown.select("MODEL_YEAR", "total", "prev_year", (F.col("total") - F.col("prev_year")).alias("jump"))
    return top_k(jump, 1, F.col("jump").desc(), F.col("MODEL_YEAR").asc_nulls_last())


def adoption_trend(t: Tables) -> DataFrame:
    return t["agg_by_year"].select("MODEL_YEAR", "EV_TYPE", "CUMULATIVE_COUNT", "TARGET_EV_COUNT").orderBy(
        F.col("MODEL_YEAR").asc_nulls_last(), "EV_TYPE"
    )


def target_line(t: Tables) -> DataFrame:
    """One target per model year that has one."""
    with_target = t["agg_by_year"].where(F.col("TARGET_EV_COUNT").isNotNull())
    return with_target.groupBy("MODEL_YEAR").agg(F.max("TARGET_EV_COUNT").alias("TARGET_EV_COUNT"))


def goal_share_of_year(t: Tables, year: int) -> DataFrame:
    """All registrations up to the year against its target: types without a row in that year count too."""
    until = t["agg_by_year"].where(F.col("MODEL_YEAR") <= year)
    totals = until.agg(
        F.sum("REGISTRATION_COUNT").alias("cumulative"),
        F.max(F.when(F.col("MODEL_YEAR") == year, F.col("TARGET_EV_COUNT"))).alias("target"),
        F.max("MODEL_YEAR").alias("MODEL_YEAR"),
    ).where(F.col("MODEL_YEAR") == year)
    return totals.select(
        "MODEL_YEAR", "cumulative", "target", percent_double("cumulative", "target").alias("pct_of_target")
    )


def goal_projection(t: Tables, target_year: int = 2030) -> DataFrame:
    """Least-squares line through the running total of all types, read off at the target year."""
    per_year = t["agg_by_year"].where(F.col("MODEL_YEAR").isNotNull()).groupBy("MODEL_YEAR").agg(
        F.sum("REGISTRATION_COUNT").alias("total")
    )
    per_year = running_total(per_year, "total", [], "MODEL_YEAR", "cumulative")
    line = per_year.agg(
        F.regr_slope("cumulative", "MODEL_YEAR").alias("slope"),
        F.regr_intercept("cumulative", "MODEL_YEAR").alias("intercept"),
    )
    target = t["state_goals"].where(F.col("year") == target_year).agg(F.max("target_ev_count")).scalar()
    projected = F.col("slope") * target_year + F.col("intercept")
    return line.select(
        F.lit(target_year).alias("target_year"),
        F.round(projected, 2).alias("projected"),
        target.cast("bigint").alias("target"),
        (projected >= target).alias("on_track"),
    )


# Geography

def top_counties(t: Tables, k: int = 15) -> DataFrame:
    grouped = t["agg_by_county"].groupBy("COUNTY").agg(
        F.sum("REGISTRATION_COUNT").alias("total_registrations"),
        F.max("POPULATION").alias("population"),
        F.max("REGISTRATIONS_PER_CAPITA").alias("per_capita"),
    )
    return top_k(grouped, k, F.col("total_registrations").desc(), F.col("COUNTY").asc_nulls_last())


def top_counties_per_capita(t: Tables, k: int = 10, nulls: str = "last") -> DataFrame:
    grouped = t["agg_by_county"].groupBy("COUNTY").agg(
        F.sum("REGISTRATION_COUNT").alias("total"),
        F.max("REGISTRATIONS_PER_CAPITA").alias("per_capita"),
    )
    order = F.col("per_capita")
    first = order.desc_nulls_last() if nulls == "last" else order.desc_nulls_first()
    return top_k(grouped, k, first, F.col("COUNTY").asc_nulls_last())


def registrations_per_station(t: Tables) -> DataFrame:
    """By county; stations are counted once per zip code."""
    silver = t["silver"]
    zips = silver.groupBy("COUNTY", "POSTAL_CODE").agg(
        _count().alias("n"), F.max("EV_CHARGING_STATIONS").alias("stations")
    )
    counties = zips.groupBy("COUNTY").agg(F.sum("n").alias("registrations"), F.sum("stations").alias("stations"))
    return counties.where(F.col("stations") > 0).withColumn(
        "per_station", F.round(F.col("registrations") / F.col("stations"), 4)
    ).orderBy(F.col("per_station").desc(), "COUNTY")


def districts_behind_goal(t: Tables) -> DataFrame:
    """Registrations per district and model year against that year's state goal."""
    grouped = t["silver"].where(F.col("TARGET_EV_COUNT").isNotNull()).groupBy("LEGISLATIVE_DISTRICT", "MODEL_YEAR").agg(
        _count().alias("registrations"), F.max("TARGET_EV_COUNT").alias("target")
    )
    return grouped.withColumn("shortfall", F.col("target") - F.col("registrations")).orderBy(
        F.col("shortfall").desc(), "LEGISLATIVE_DISTRICT", "MODEL_YEAR"
    )


def growth_contribution(t: Tables, year: int) -> DataFrame:
    """How much each county adds to the change in registrations from the year before."""
    silver = t["silver"].where(F.col("MODEL_YEAR").isin(year - 1, year))
    grouped = silver.groupBy("COUNTY").agg(
        F.count_if(F.col("MODEL_YEAR") == year).alias("this_year"),
        F.count_if(F.col("MODEL_YEAR") == year - 1).alias("last_year"),
    )
    change = grouped.withColumn("change", F.col("this_year") - F.col("last_year"))
    total = change.agg(F.sum("change")).scalar()
    return change.withColumn("contribution_pct", percent_double(F.col("change"), total)).orderBy(
        F.col("change").desc(), "COUNTY"
    )


# Makes, models and types

def market_share(t: Tables) -> DataFrame:
    return with_share(count_by(t["dim_vehicle"], ["EV_TYPE"], "registrations"), "registrations", "market_share_pct")


def top_makes(t: Tables, k: int = 10) -> DataFrame:
    grouped = count_by(t["dim_vehicle"], ["MAKE"], "registrations", avg_range=F.avg("ELECTRIC_RANGE"))
    return top_k(grouped, k, F.col("registrations").desc(), F.col("MAKE").asc_nulls_last())


def top_models(t: Tables, k: int = 10) -> DataFrame:
    grouped = count_by(t["dim_vehicle"], ["MAKE", "MODEL"], "registrations", avg_range=F.avg("ELECTRIC_RANGE"))
    return top_k(
        grouped, k, F.col("registrations").desc(), F.col("MAKE").asc_nulls_last(), F.col("MODEL").asc_nulls_last()
    )


def eligibility_split(t: Tables) -> DataFrame:
    grouped = count_by(t["fact_registrations"], ["CAFV_ELIGIBILITY"], "vehicles")
    return with_share(grouped, "vehicles", "pct").orderBy(F.col("vehicles").desc(), "CAFV_ELIGIBILITY")


def range_by_make(t: Tables) -> DataFrame:
    return t["dim_vehicle"].groupBy("MAKE").agg(F.avg("ELECTRIC_RANGE").alias("avg_range")).orderBy("MAKE")


def make_share_by_region(t: Tables) -> DataFrame:
    """Share of each make within its county; the window reads one row per make and county."""
    grouped = count_by(t["silver"], ["COUNTY", "MAKE"], "registrations")
    total = F.sum("registrations").over(Window.partitionBy("COUNTY"))
    return grouped.withColumn("share_pct", percent_double(F.col("registrations"), total))


def models_in_rich_zips(t: Tables, year: int, min_income: int = 100_000, k: int = 10) -> DataFrame:
    """Models that gained most registrations over the year before, with both years' counts."""
    rich = t["silver"].where((F.col("MEDIAN_INCOME") > min_income) & F.col("MODEL_YEAR").isin(year - 1, year))
    grouped = rich.groupBy("MAKE", "MODEL").agg(
        F.count_if(F.col("MODEL_YEAR") == year).alias("this_year"),
        F.count_if(F.col("MODEL_YEAR") == year - 1).alias("last_year"),
    ).withColumn("growth", F.col("this_year") - F.col("last_year"))
    return top_k(grouped, k, F.col("growth").desc(), F.col("this_year").desc(), "MAKE", "MODEL")


def top_models_in_county(t: Tables, county: str, year: int | None = None, k: int = 5) -> DataFrame:
    """Of one model year, or of all."""
    rows = t["silver"].where(F.col("COUNTY") == county)
    if year is not None:
        rows = rows.where(F.col("MODEL_YEAR") == year)
    return top_k(count_by(rows, ["MAKE", "MODEL"], "registrations"), k, F.col("registrations").desc(), "MAKE", "MODEL")


def county_mix_against_state(t: Tables, county: str) -> DataFrame:
    """Share of each make in one county next to its share overall."""
    grouped = t["silver"].groupBy("MAKE").agg(
        F.count_if(F.col("COUNTY") == county).alias("in_county"), _count().alias("overall")
    )
    shares = with_share(with_share(grouped, "in_county", "county_pct"), "overall", "state_pct")
    return shares.orderBy(F.col("in_county").desc(), "MAKE")


# Incentive program

def approval_by_zip(t: Tables) -> DataFrame:
    return _approval(t["incentive_applications"], "applicant_zip").orderBy(
        F.col("total_applications").desc(), "applicant_zip"
    )


def approval_by_vehicle_type(t: Tables) -> DataFrame:
    return _approval(t["incentive_applications"], "vehicle_type").orderBy("vehicle_type")


def _approval(applications: DataFrame, key: str) -> DataFrame:
    grouped = applications.groupBy(key).agg(
        _count().alias("total_applications"), F.count_if(_approved()).alias("approved")
    )
    return grouped.withColumn("approval_rate_pct", percent_double("approved", "total_applications"))


def backlog_by_status(t: Tables) -> DataFrame:
    grouped = t["incentive_applications"].groupBy("status").agg(
        _count().alias("application_count"), F.sum("incentive_amount").cast("double").alias("total_amount")
    )
    return grouped.orderBy(F.col("application_count").desc(), "status")


def busy_zips_low_approval(t: Tables, more_than: int = 50) -> DataFrame:
    """Zip codes with applications and many vehicles, with their approval rate.

    Vehicles are counted per place first, so the geography join reads one row per place, not per vehicle.
    """
    keys = ["POSTAL_CODE", "COUNTY", "POPULATION"]
    per_place = t["fact_registrations"].groupBy("GEO_KEY").agg(F.countDistinct("VIN").alias("n"))
    places = t["dim_geography"].select(F.col("GEO_KEY").alias("PLACE"), *keys).distinct()
    demand = per_place.join(places, per_place["GEO_KEY"] == places["PLACE"]).groupBy(*keys).agg(
        F.sum("n").alias("registrations")
    )
    approval = _approval(t["incentive_applications"], "applicant_zip").select(
        "applicant_zip", F.col("total_applications").alias("total_apps"), "approval_rate_pct"
    )
    joined = left_lookup(demand, approval, {"POSTAL_CODE": "applicant_zip"})
    return joined.where((F.col("total_apps") > 0) & (F.col("registrations") > more_than)).orderBy(
        F.col("registrations").desc(), F.col("approval_rate_pct").asc_nulls_last(), "POSTAL_CODE"
    )


def incentive_cards(t: Tables) -> DataFrame:
    """Totals of matched applications; status is compared without regard to case."""
    status = F.upper("APPLICATION_STATUS")
    facts = t["fact_registrations"].where(status.isNotNull() & (status != "NONE"))
    amount = F.col("INCENTIVE_AMOUNT")
    cards = facts.agg(
        _count().alias("total_applications"),
        F.count_if(status == "APPROVED").alias("approved"),
        F.count_if(status == "PENDING").alias("pending"),
        F.count_if(status == "DENIED").alias("denied"),
        F.coalesce(F.sum(amount), F.lit(0)).cast("double").alias("total_requested"),
        F.coalesce(sum_where(status == "APPROVED", amount), F.lit(0)).cast("double").alias("total_approved"),
    )
    return cards.withColumn("approval_rate_pct", percent_double("approved", "total_applications", 1))


def newest_applications(t: Tables, k: int = 5) -> DataFrame:
    rows = t["incentive_applications"].select(
        "application_id", "vin", "submitted_date", "make", "model", "applicant_zip", "incentive_amount",
        "status", "reviewed_date",
    )
    return top_k(rows, k, F.col("submitted_date").desc_nulls_first(), F.col("application_id").desc())


def denial_reasons(t: Tables) -> DataFrame:
    denied = t["incentive_applications"].where(F.col("status") == "DENIED")
    return count_by(denied, ["denial_reason"], "denials").orderBy(F.col("denials").desc(), "denial_reason")


def denied_for(t: Tables, reason: str) -> DataFrame:
    return t["incentive_applications"].where((F.col("status") == "DENIED") & (F.col("denial_reason") == reason))


def review_days(t: Tables) -> DataFrame:
    return t["incentive_applications"].agg(
        F.round(F.avg(days_between("submitted_date", "reviewed_date")), 4).alias("avg_days")
    )


def total_disbursed(t: Tables) -> DataFrame:
    return t["incentive_applications"].agg(
        sum_where(_approved(), "incentive_amount").cast("double").alias("total_disbursed")
    )


def pending_without_stations(t: Tables) -> DataFrame:
    """Pending applications by zip code that has no charging station on record."""
    pending = t["incentive_applications"].where(F.col("status") == "PENDING")
    grouped = count_by(pending, ["applicant_zip"], "pending")
    zips = t["zip_demographics"].select("zip_code", "ev_charging_stations")
    joined = left_lookup(grouped, zips, {"applicant_zip": "zip_code"})
    return joined.where(F.coalesce("ev_charging_stations", F.lit(0)) == 0).select("applicant_zip", "pending").orderBy(
        F.col("pending").desc(), "applicant_zip"
    )


def rich_zip_split(t: Tables, min_income: int = 100_000) -> DataFrame:
    """Types and approval rate of vehicles in zip codes above an income."""
    rich = t["silver"].where(F.col("MEDIAN_INCOME") > min_income)
    grouped = rich.groupBy("EV_TYPE").agg(
        _count().alias("registrations"),
        F.count("APPLICATION_STATUS").alias("applications"),
        F.count_if(F.col("APPLICATION_STATUS") == "APPROVED").alias("approved"),
    )
    shares = with_share(grouped, "registrations", "share_pct")
    return shares.withColumn("approval_rate_pct", percent_double("approved", "applications"))


def approved_models(t: Tables, k: int = 10) -> DataFrame:
    grouped = count_by(t["incentive_applications"].where(_approved()), ["make", "model"], "approved")
    return top_k(grouped, k, F.col("approved").desc(), "make", "model")


# Listings and samples

def goals_listing(t: Tables) -> DataFrame:
    return t["state_goals"].orderBy("year", "state")


def enriched_sample(t: Tables, k: int = 5) -> DataFrame:
    """The first k vehicles, by VIN, whose zip code has demographics."""
    found = t["silver"].where(F.col("POPULATION").isNotNull()).select(
        "VIN", "MAKE", "MODEL", "COUNTY", "POSTAL_CODE", "POPULATION", "MEDIAN_INCOME", "EV_CHARGING_STATIONS",
        "TARGET_EV_COUNT", "POLICY_NAME", "INCENTIVE_AMOUNT", "APPLICATION_STATUS",
    )
    return top_k(found, k, F.col("VIN"))


def parsed_sample(t: Tables, k: int = 5) -> DataFrame:
    """The first k parsed rows, by document and place in it."""
    return top_k(t["bronze"], k, F.col("SOURCE_FILE"), F.col("RECORD_POSITION")).select(
        "VIN", "MAKE", "MODEL", "MODEL_YEAR", "EV_TYPE", "COUNTY", "POSTAL_CODE", "ELECTRIC_RANGE"
    )


def raw_sample(t: Tables, k: int = 1) -> DataFrame:
    """The first k landed documents, by source file."""
    return top_k(t["raw"].select("raw_data", "loaded_at", "source_file"), k, F.col("source_file"))
