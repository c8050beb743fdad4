"""Locations: parsing, text forms, lookup keys and removal of location mentions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_null, collapse, strip

LOCATION = "struct<city:string,state:string,country:string>"
HOME = "US"

# Spellings of the home country.
HOME_SPELLINGS = ["united states", "usa", "us", "united states of america"]

# The words that introduce a location mention.
INTRODUCTIONS = (
    "in|at|located in|based in|from|work in|work at|work from|relocate to|relocation to|relocating to|location:?"
)

# Place names that may close a location mention; the first one that fits is taken.
PLACES = (
    "United States|USA|US|Canada|UK|United Kingdom|Australia|India|Germany|France|Spain|Italy|Singapore|Remote|"
    "Anywhere|Europe|Asia|Africa|America|Mexico|Brazil|Argentina|China|Japan|Korea|Russia|Turkey|UAE|Netherlands|"
    "Sweden|Norway|Finland|Denmark|Switzerland|Belgium|Ireland|Poland|Portugal|Greece|Czech Republic|Hungary|"
    "Romania|South Africa|Egypt|Nigeria|Kenya|Pakistan|Bangladesh|Indonesia|Malaysia|Philippines|Thailand|Vietnam|"
    "New Zealand|Chile|Colombia|Peru|Venezuela|Uruguay|Paraguay|Bolivia|Ecuador|Costa Rica|Panama|Guatemala|"
    "Honduras|El Salvador|Nicaragua|Cuba|Puerto Rico|Jamaica|Trinidad|Barbados|Bahamas|Dominican Republic|Haiti|"
    "Morocco|Algeria|Tunisia|Libya|Sudan|Ethiopia|Tanzania|Uganda|Ghana|Ivory Coast|Cameroon|Senegal|Zambia|"
    "Zimbabwe|Botswana|Namibia|Mozambique|Angola|Madagascar|Malawi|Mali|Niger|Burkina Faso|Benin|Rwanda|Burundi|"
    "Togo|Sierra Leone|Liberia|Congo|Gabon|Mauritius|Seychelles|Comoros|Lesotho|Swaziland|Somalia|Djibouti|"
    "Eritrea|South Sudan|Central African Republic|Chad|Guinea|Guinea-Bissau|Gambia|Cape Verde|Sao Tome|"
    "Equatorial Guinea|Western Sahara|Palestine|Israel|Lebanon|Jordan|Syria|Iraq|Iran|Afghanistan|Saudi Arabia|"
    "Qatar|Kuwait|Bahrain|Oman|Yemen|Armenia|Azerbaijan|Georgia|Kazakhstan|Uzbekistan|Turkmenistan|Kyrgyzstan|"
    "Tajikistan|Mongolia|Nepal|Bhutan|Sri Lanka|Maldives|Brunei|East Timor|Laos|Cambodia|Myanmar|North Korea|"
    "Taiwan|Hong Kong|Macau|Greenland|Iceland|Faroe Islands|Svalbard|Jan Mayen|Falkland Islands|French Guiana|"
    "Guadeloupe|Martinique|Reunion|Mayotte|New Caledonia|French Polynesia|Wallis and Futuna|Saint Pierre|Miquelon|"
    "Saint Barthelemy|Saint Martin|Saint Helena|Ascension|Tristan da Cunha|Anguilla|Bermuda|British Virgin Islands|"
    "Cayman Islands|Montserrat|Turks and Caicos Islands|Gibraltar|Pitcairn Islands|South Georgia|"
    "South Sandwich Islands|British Antarctic Territory|British Indian Ocean Territory|Antarctica|Other"
).split("|")


def location_mention(places: Sequence[str] = PLACES) -> str:
    """The pattern of a location mention: introduction, words, code, postcode and a place name."""
    return (
        rf"\b(?:{INTRODUCTIONS})\s+[A-Za-z .'-]+,?\s*[A-Z]{{2,}}(?:\s*-\s*\d{{5}})?"
        rf"(,?\s*({'|'.join(places)}))?"
    )


def remove_location_mentions(col: Column, places: Sequence[str] = PLACES) -> Column:
    """Text without location mentions, collapsed and lower case; null gives ''.

    The pattern ignores case, so a "code" may be any word. That is deliberate: it defines which
    texts count as equal when postings are merged.
    """
    text = F.regexp_replace(F.coalesce(col, F.lit("")), f"(?i){location_mention(places)}", "")
    return F.lower(collapse(text))


def location(city: Column, state: Column, country: Column) -> Column:
    return F.struct(city.alias("city"), state.alias("state"), country.alias("country"))


def _missing() -> Column:
    return F.lit(None).cast("string")


def home_country(col: Column) -> Column:
    """``US`` for its other spellings and for a missing country."""
    return F.when(col.isNull() | F.lower(col).isin(HOME_SPELLINGS), F.lit(HOME)).otherwise(col)


def locations_from_text(col: Column) -> Column:
    """``"City, ST, Country"``, ``"City, ST"`` or ``"City"`` as an array of one location.

    Missing text and any other number of parts give one location that only names the home country.
    """
    parts = F.transform(F.split(col, ","), strip)
    home = F.lit(HOME)
    one = (
        F.when(col.isNull() | (col == ""), location(_missing(), _missing(), home))
        .when(F.size(parts) == 1, location(F.get(parts, 0), _missing(), home))
        .when(F.size(parts) == 2, location(F.get(parts, 0), F.get(parts, 1), home))
        .when(F.size(parts) == 3, location(F.get(parts, 0), F.get(parts, 1), home_country(F.get(parts, 2))))
        .otherwise(location(_missing(), _missing(), home))
    )
    return F.array(one)


def locations_from_structs(col: Column) -> Column:
    """An array of location structs with default countries; null and empty arrays give the home country."""
    filled = F.transform(col, lambda x: location(x["city"], x["state"], home_country(x["country"])))
    home = F.array(location(_missing(), _missing(), F.lit(HOME)))
    return F.when(F.coalesce(F.size(col), F.lit(0)) > 0, filled).otherwise(home)


def locations_from_columns(city: Column, state: Column, country: Column, text: Column) -> Column:
    """A location from separate columns when any of them is filled, else from the text."""
    city, state, country = blank_to_null(city), blank_to_null(state), blank_to_null(country)
    parts = F.array(location(city, state, home_country(country)))
    return F.when(F.coalesce(city, state, country).isNotNull(), parts).otherwise(locations_from_text(text))


def _filled(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def location_string(col: Column) -> Column:
    """``"Boston MA US, Paris France"``; null gives ''."""
    one = F.transform(
        col, lambda x: F.concat_ws(" ", _filled(x["city"]), _filled(x["state"]), _filled(x["country"]))
    )
    return F.coalesce(F.array_join(one, ", "), F.lit(""))


def geo_query(col: Column) -> Column:
    """The lookup key of a list of locations, null when there is nothing to look up.

    One location gives all its parts, several in one state give the state, others the first country.
    """
    first = F.get(col, 0)
    country = F.coalesce(first["country"], F.lit(HOME))
    states = F.array_distinct(F.array_compact(F.transform(col, lambda x: _filled(x["state"]))))
    whole = F.concat_ws(", ", _filled(first["city"]), _filled(first["state"]), _filled(first["country"]))
    key = (
        F.when(F.size(col) == 1, whole)
        .when(F.size(states) == 1, F.concat_ws(", ", F.get(states, 0), country))
        .otherwise(country)
    )
    return F.when(F.coalesce(F.size(col), F.lit(0)) > 0, F.nullif(key, F.lit("")))


def wkt_point(geo: Column) -> Column:
    """``POINT(lng lat)``, null when a coordinate is missing."""
    lng, lat = geo["lng"].cast("string"), geo["lat"].cast("string")
    return F.concat(F.lit("POINT("), lng, F.lit(" "), lat, F.lit(")"))
