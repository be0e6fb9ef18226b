"""Rules that fill country, category, seniority and a clean description from text."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postings.functions.text import WS, let, squash

# How a location may name a country, besides the full name itself.
COUNTRY_ALIASES = {
    "United States": ["us", "usa", "u.s.", "u.s.a.", "united states of america"],
    "United Kingdom": ["uk", "u.k.", "england", "scotland", "wales", "great britain"],
    "Netherlands": ["the netherlands", "nl"],
    "Germany": ["de", "deutschland"],
    "United Arab Emirates": ["uae"],
    "South Korea": ["korea"],
    "Czech Republic": ["czechia"],
    "Turkey": ["türkiye"],
}
COUNTRIES = [
    "United States", "United Kingdom", "Canada", "Germany", "France", "Netherlands", "Ireland", "Spain",
    "Portugal", "Italy", "Switzerland", "Austria", "Belgium", "Luxembourg", "Denmark", "Sweden", "Norway",
    "Finland", "Poland", "Czech Republic", "Hungary", "Romania", "Greece", "Turkey", "Israel", "India",
    "Singapore", "Japan", "South Korea", "China", "Taiwan", "Philippines", "Vietnam", "Thailand",
    "Indonesia", "Malaysia", "Australia", "New Zealand", "Brazil", "Mexico", "Argentina", "Chile",
    "Colombia", "South Africa", "Nigeria", "Kenya", "Egypt", "United Arab Emirates", "Saudi Arabia",
    "Ukraine",
]
US_STATES = (
    "AL AK AZ AR CA CO CT DE FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY NC "
    "ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY DC"
).split()
US_STATE_NAMES = [
    "Alabama", "Alaska", "Arizona", "Arkansas", "California", "Colorado", "Connecticut", "Delaware", "Florida", "Georgia",
    "Hawaii", "Idaho", "Illinois", "Indiana", "Iowa", "Kansas", "Kentucky", "Louisiana", "Maine", "Maryland", "Massachusetts",
    "Michigan", "Minnesota", "Mississippi", "Missouri", "Montana", "Nebraska", "Nevada", "New Hampshire", "New Jersey",
    "New Mexico", "New York", "North Carolina", "North Dakota", "Ohio", "Oklahoma", "Oregon", "Pennsylvania", "Rhode Island",
    "South Carolina", "South Dakota", "Tennessee", "Texas", "Utah", "Vermont", "Virginia", "Washington", "West Virginia",
    "Wisconsin", "Wyoming", "District of Columbia",
]
#: Cities that tell a country's code from the equal code of a state (and the country Georgia from the state).
CITIES = {
    "AL": ["Tirana", "Durrës"],
    "AR": ["Buenos Aires", "Córdoba", "Rosario", "Mendoza"],
    "AZ": ["Baku"],
    "CA": ["Toronto", "Montreal", "Vancouver", "Calgary", "Ottawa", "Edmonton", "Winnipeg", "Quebec", "Halifax", "Waterloo", "Kitchener", "Mississauga"],
    "CO": ["Bogotá", "Medellín", "Cali", "Barranquilla", "Cartagena"],
    "DE": ["Berlin", "Munich", "München", "Hamburg", "Frankfurt", "Cologne", "Köln", "Stuttgart", "Düsseldorf", "Leipzig", "Dresden", "Hannover", "Bonn"],
    "GA": ["Libreville"],
    "GE": ["Tbilisi", "Batumi", "Kutaisi"],
    "ID": ["Jakarta", "Bandung", "Surabaya", "Denpasar"],
    "IL": ["Tel Aviv", "Jerusalem", "Haifa", "Herzliya", "Ramat Gan"],
    "IN": ["Chennai", "Bangalore", "Bengaluru", "Mumbai", "Delhi", "Hyderabad", "Pune", "Kolkata", "Gurgaon", "Gurugram", "Noida", "Ahmedabad", "Jaipur", "Kochi"],
    "LA": ["Vientiane"],
    "MA": ["Casablanca", "Rabat", "Marrakesh", "Tangier"],
    "MD": ["Chișinău", "Chisinau"],
    "ME": ["Podgorica"],
    "MN": ["Ulaanbaatar"],
    "MT": ["Valletta", "Sliema"],
    "NE": ["Niamey"],
    "PA": ["Panama City"],
    "SD": ["Khartoum"],
    "TN": ["Tunis"],
}

# Title keywords per category, tried in this order.
CATEGORY_RULES = [
    ("Data Science", r"data scien|machine learning|\bml\b|\bai\b|deep learning"),
    ("Security", r"security|cyber"),
    ("Product Management", r"product manager|program manager|product management"),
    ("Design", r"design|\bux\b|\bui\b"),
    ("Customer Success", r"customer|support|success"),
    ("Sales", r"sales|account executive"),
    ("Marketing", r"marketing|content|growth"),
    ("Finance", r"financ|account|treasur"),
    ("HR", r"human resources|recruit|people|\bhr\b"),
    ("Legal", r"legal|counsel|compliance"),
    ("Research", r"research"),
    ("Operations", r"operations|logistics|supply chain"),
    ("Engineering", r"engineer|software|developer|hardware|\bswe\b|systems"),
]

# Title keywords per seniority, tried in this order; a title without any is "mid".
SENIORITY_RULES = [
    ("intern", r"\bintern\b|\binternship\b|\bco-?op\b"),
    ("executive", r"\bceo\b|\bcto\b|\bcfo\b|\bcxo\b|\bchief\b|\bc-level\b"),
    ("director_vp", r"\bdirector\b|\bvp\b|\bvice president\b|\bhead of\b|\bengineering manager\b"),
    ("staff", r"\bstaff\b|\bprincipal\b|\bdistinguished\b"),
    ("senior", r"\bsenior\b|\bsr\b|\blead\b"),
    ("entry", r"\bentry\b|\bnew grad\b|\bjunior\b|\bjr\b"),
]


def _first_match(text: Column, rules: list[tuple[str, str]], default: str) -> Column:
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for value, pattern in rules:
        out = out.when(text.rlike(pattern), F.lit(value))
    return out.otherwise(F.lit(default))


#: Accented letters and what they are compared as.
_ACCENTS = "áàâãäåçéèêëíìîïñóòôõöøúùûüýÿșăşı", "aaaaaaceeeeiiiinoooooouuuuyysasi"


def gazetteer(spark: SparkSession) -> tuple[list[str], dict[str, str]]:
    """Country names, and names by code: those above and the rest of ISO 3166 by the JVM's own table (English names)."""
    locale = spark._jvm.java.util.Locale
    known = {normal_name(n): c for c, names in COUNTRY_ALIASES.items() for n in [c, *names]} | {normal_name(c): c for c in COUNTRIES}
    names, codes = list(COUNTRIES), {}
    for code in locale.getISOCountries():
        place = locale("", code)
        plain = place.getDisplayCountry(locale.ENGLISH).replace("\u2019", "'").replace(" & ", " and ")
        name = known.get(normal_name(plain), plain)
        codes[code] = codes[place.getISO3Country()] = name
        if name == plain and name not in names:
            names.append(name)
    return names, codes


def normal_name(name: str) -> str:
    """A name as it is compared: lower case, no accents, words joined by one space."""
    return " ".join(re.findall(r"[^\W\d_]+", name.lower().translate(str.maketrans(*_ACCENTS))))


def _name_words(text: Column) -> Column:
    """Words of a text in the form of :func:`normal_name`."""
    return F.array_remove(F.split(F.translate(F.lower(text), *_ACCENTS), r"[^\p{L}]+"), "")


def _phrases(words: Column, heads: list[str], longest: int) -> Column:
    """Phrases of up to ``longest`` words that begin with one of ``heads``: by place, longer ones first."""
    at = F.filter(F.transform(words, lambda w, i: F.when(w.isin(heads), i + 1)), lambda i: i.isNotNull())
    sizes = F.array(*[F.lit(k) for k in range(longest, 0, -1)])
    return F.flatten(F.transform(at, lambda i: F.transform(sizes, lambda k: F.array_join(F.slice(words, i, k), " "))))


def _lookup(key: Column, table: dict[str, str]) -> Column:
    """``table[key]``; the membership test is a hash lookup, so the map is searched only for keys it has."""
    found = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.when(key.isin(list(table)), found[key])


def infer_country(jobs: DataFrame, location: str = "location", out: str = "country") -> DataFrame:
    """Full country name from a location, "Unknown" when none can be told.

    The last comma part decides, if it is as a whole: an upper-case US state code (if it is a country's code too, and a
    city of that country stands before it, the country), another name of a country, a US state, a country, or an upper-case
    ISO code. Else the first country or state named anywhere decides, of several names at one place the longest ("New
    Mexico", not "Mexico"). "Georgia" behind another part is the state, unless that part names a city of the country;
    within a text it decides nothing. Accents and case are ignored in names.
    """
    names, codes = gazetteer(jobs.sparkSession)
    us = "United States"
    aliases = {normal_name(a): c for c, others in COUNTRY_ALIASES.items() for a in others}
    states = {normal_name(n): us for n in US_STATE_NAMES if n != "Georgia"}
    countries = {normal_name(n): n for n in names if n != "Georgia"}
    mentioned = countries | states
    cities = [f"{code} {normal_name(c)}" for code, found in CITIES.items() for c in found]
    heads = sorted({n.split(" ")[0] for n in mentioned})
    city_heads = sorted({c.split(" ")[1] for c in cities})
    longest = max(n.count(" ") + 1 for n in mentioned)

    def before(text: Column) -> Column:
        """The text before the last part."""
        return F.substring(text, F.lit(1), F.greatest(F.length(text) - F.length(F.substring_index(text, ",", -1)), F.lit(0)))

    def city_of(code: Column, text: Column) -> Column:
        return F.exists(_phrases(_name_words(before(text)), city_heads, 2), lambda c: F.concat(code, F.lit(" "), c).isin(cities))

    def decide(text: Column) -> Column:
        last = F.trim(F.substring_index(text, ",", -1))
        behind = text.contains(",")
        state = last.isin(US_STATES)
        def whole(key: Column) -> Column:
            return F.coalesce(
                _lookup(key, aliases), _lookup(key, states),
                F.when(key == "georgia", F.when(behind & ~city_of(F.lit("GE"), text), F.lit(us)).otherwise(F.lit("Georgia"))),
                _lookup(key, countries), F.when(~state, _lookup(last, codes)))
        by_last = let(F.array_join(_name_words(last), " "), whole)
        by_state = F.when(state & behind, F.when(city_of(last, text), _lookup(last, codes)).otherwise(F.lit(us)))
        first = let(_name_words(text), lambda words: F.get(F.filter(_phrases(words, heads, longest), lambda p: p.isin(list(mentioned))), F.lit(0)))
        by_mention = let(first, lambda p: _lookup(p, mentioned))
        return F.coalesce(by_state, by_last, by_mention, F.lit("Unknown"))

    return jobs.withColumn(out, let(squash(F.col(location)), decide))


def infer_category(jobs: DataFrame, title: str = "title", out: str = "team_or_category") -> DataFrame:
    """One of fourteen categories by title keywords, "Other" by default."""
    return jobs.withColumn(out, _first_match(F.lower(F.coalesce(F.col(title), F.lit(""))), CATEGORY_RULES, "Other"))


def infer_seniority(jobs: DataFrame, title: str = "title", out: str = "seniority_bucket") -> DataFrame:
    """Bucket by title keywords; "mid" for a title without any, "unknown" for no title.

    "staff" is told apart here; normalising the bucket afterwards folds it into "senior".
    """
    text = F.lower(F.coalesce(squash(F.col(title)), F.lit("")))
    return jobs.withColumn(out, F.when(text == "", F.lit("unknown")).otherwise(_first_match(text, SENIORITY_RULES, "mid")))


def clean_description(df: DataFrame, html: str, out: str = "job_description", max_chars: int | None = None) -> DataFrame:
    """Text of an HTML description: tags dropped, paragraphs kept apart by a blank line; cut only if asked to."""
    text = F.regexp_replace(F.col(html), r"(?is)<(script|style|noscript|template)(?=[\s/>]).*?</\1\s*>", "")
    text = F.regexp_replace(text, r"(?s)<!--.*?-->", "")
    text = F.regexp_replace(text, r"(?i)</?(?:p|div|section|article|ul|ol|li|h[1-6]|tr|table)\b[^>]*>|<br\s*/?>", "\u0001")
    text = F.regexp_replace(text, r"<[^>]*>", "")
    text = F.regexp_replace(text, WS + "+", " ")
    text = F.regexp_replace(text, r"( ?\x01 ?)+", "\n\n")
    text = F.regexp_replace(text, r"^[ \n]+|[ \n]+\z", "")
    return df.withColumn(out, F.coalesce(F.substring(text, 1, max_chars) if max_chars else text, F.lit("")))
