"""Fixed dimension values.

Lists longer than these (countries, country codes per region, map names) are tables that the
caller lands: a country table, and the fetch log itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dossierkit.functions.text import lookup, normalise_name

# Category -> metric -> page of the metric.
METRICS = {
    "Manpower": {
        "total_population": "total-population-by-country.php",
        "available_manpower": "available-military-manpower.php",
        "fit_for_service": "manpower-fit-for-military-service.php",
        "reaching_military_age": "manpower-reaching-military-age-annually.php",
        "active_service": "active-military-manpower.php",
        "active_reserves": "active-reserve-military-manpower.php",
        "paramilitary": "manpower-paramilitary.php",
    },
    "Airpower": {
        "aircraft_total": "aircraft-total.php",
        "fighters_interceptors": "aircraft-total-fighters.php",
        "attack_strike": "aircraft-total-attack-types.php",
        "transports_fixed_wing": "aircraft-total-transports.php",
        "trainer_fleets": "aircraft-total-trainers.php",
        "special_mission": "aircraft-total-special-mission.php",
        "tanker_fleets": "aircraft-total-tanker-fleet.php",
        "helicopter_fleets": "aircraft-helicopters-total.php",
        "attack_helicopters": "aircraft-helicopters-attack.php",
    },
    "Land Forces": {
        "tank_strengths": "armor-tanks-total.php",
        "armored_fighting_vehicles": "armor-apc-total.php",
        "self_propelled_artillery": "armor-self-propelled-guns-total.php",
        "towed_artillery": "armor-towed-artillery-total.php",
        "rocket_projectors": "armor-mlrs-total.php",
    },
    "Naval Forces": {
        "naval_fleet_strength": "navy-ships.php",
        "fleet_tonnage_strength": "navy-force-by-tonnage.php",
        "aircraft_carriers": "navy-aircraft-carriers.php",
        "helicopter_carriers": "navy-helo-carriers.php",
        "submarines": "navy-submarines.php",
        "destroyers": "navy-destroyers.php",
        "frigates": "navy-frigates.php",
        "corvettes": "navy-corvettes.php",
        "coastal_patrol_craft": "navy-patrol-coastal-craft.php",
        "mine_warfare_craft": "navy-mine-warfare-craft.php",
    },
    "Finances": {
        "defense_budgets": "defense-spending-budget.php",
        "external_debt": "external-debt-by-country.php",
        "purchasing_power_parity": "purchasing-power-parity.php",
        "foreign_exchange_reserves": "reserves-of-foreign-exchang-and-gold.php",
    },
    "Logistics": {
        "airports": "major-serviceable-airports-by-country.php",
        "labor_force_strength": "labor-force-by-country.php",
        "major_ports_terminals": "major-ports-and-terminals.php",
        "merchant_marine_strength": "merchant-marine-strength-by-country.php",
        "railway_coverage": "railway-coverage.php",
        "roadway_coverage": "roadway-coverage.php",
    },
    "Natural Resources": {
        "oil_production": "oil-production-by-country.php",
        "oil_consumption": "oil-consumption-by-country.php",
        "proven_oil_reserves": "proven-oil-reserves-by-country.php",
        "natural_gas_production": "natural-gas-production-by-country.php",
        "natural_gas_consumption": "natural-gas-consumption-by-country.php",
        "proven_natural_gas_reserves": "proven-natural-gas-reserves-by-country.php",
        "coal_production": "coal-production-by-country.php",
        "coal_consumption": "coal-consumption-by-country.php",
        "proven_coal_reserves": "proven-coal-reserves-by-country.php",
    },
}
METRIC_PAGES = {page: metric for pages in METRICS.values() for metric, page in pages.items()}
METRIC_NAMES = list(METRIC_PAGES.values())

# Field -> label (a regex) on a detail page.
DETAIL_LABELS = {
    "air_force_personnel": r"Air Force Personnel",
    "army_personnel": r"Army Personnel",
    "navy_personnel": r"Navy Personnel",
    "total_military_personnel": r"Tot Mil. Personnel",
    "yearly_mobilization_potential": r"Yearly Mobilization Potential",
    "mobilization_6_12_months": r"Mobilization 6-12mos",
    "mobilization_year_2": r"Mobilization Year 2",
    "mobilization_year_3": r"Mobilization Year 3",
    "mobilization_year_4_plus": r"Mobilization Year 4\+",
}

# Region folders in the order in which they are tried.
REGIONS = [
    "africa",
    "australia-oceania",
    "central-america-n-caribbean",
    "central-asia",
    "east-n-southeast-asia",
    "europe",
    "middle-east",
    "north-america",
    "south-america",
    "south-asia",
]

# Indicator code -> name, in column order.
INDICATORS = {
    "SP.POP.TOTL": "Population WB",
    "NY.GDP.MKTP.CD": "GDP (Current US$)",
    "NY.GDP.MKTP.KD.ZG": "GDP Growth (Annual %)",
    "NY.GDP.PCAP.CD": "GDP Per Capita (Current US$)",
    "SL.UEM.TOTL.ZS": "Unemployment Rate (%)",
    "SP.POP.GROW": "Population Growth Rate (%)",
    "MS.MIL.XPND.GD.ZS": "Defense Expenditure (% of GDP)",
}

# Names that differ between sources, per place where they are replaced.
PAGE_ALIASES = {"United States": "United States of America"}
FACTBOOK_ALIASES = {
    "United States": "United States of America",
    "Czechia": "Czech Republic",
    "Korea, South": "South Korea",
    "Korea, North": "North Korea",
}
MATCH_ALIASES = {"united states": "united states of america", "czech republic": "czechia"}
CURRENCY_ALIASES = {
    "congo, the democratic republic of the": "democratic republic of the congo",
    "korea, republic of": "south korea",
    "korea, democratic people's republic of": "north korea",
}
CODE_OVERRIDES = {"Kosovo": "XKX"}

# Map types and file types in the order in which they are tried.
MAP_TYPES = ["physical", "political"]
MAP_EXTENSIONS = ["gif", "png"]

# Countries whose name in a map URL is not just their name in lower case with hyphens.
MAP_NAMES = {
    "Antigua and Barbuda": "antigua",
    "Bosnia and Herzegovina": "bosnia",
    "Burkina Faso": "burkina",
    "Cabo Verde": "cape-verde",
    "Côte d'Ivoire": "cote-d-ivoire",
    "DR Congo": "democratic-republic-of-the-congo",
    "Eswatini": "swaziland",
    "Holy See": "vatican-city",
    "North Macedonia": "macedonia",
    "St. Vincent and Grenadines": "saint-vincent-and-the-grenadines",
    "State of Palestine": "palestine",
    "Timor-Leste": "east-timor",
}


def map_name(country: str) -> str:
    """Name of a country in a map URL."""
    return f"lower(replace({normalise_name(country, MAP_NAMES)}, ' ', '-'))"


def metric_dim(spark: SparkSession) -> DataFrame:
    """``category, metric, page, ordinal`` of the 50 metrics."""
    rows = [(cat, metric, page) for cat, pages in METRICS.items() for metric, page in pages.items()]
    return spark.createDataFrame(
        [(*row, i) for i, row in enumerate(rows)], "category string, metric string, page string, ordinal int"
    )


def metric_of(url: str) -> str:
    """Metric of a page URL; null for other pages."""
    return lookup(f"substring_index({url}, '/', -1)", METRIC_PAGES)


def country_dim(spark: SparkSession, path: str) -> DataFrame:
    """Country table (CSV with header); codes stay text because their leading zeros count."""
    schema = "`Country` string, `Alpha-2` string, `Alpha-3` string, `Numeric Code` string"
    return spark.read.schema(schema).option("header", True).csv(path)
