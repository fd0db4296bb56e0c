"""Lists that results must agree with."""

from __future__ import annotations

# Replacement first names.
FIRST_NAMES = (
    "James", "John", "Robert", "Michael", "William", "David", "Richard", "Charles",
    "Joseph", "Thomas", "Christopher", "Daniel", "Paul", "Mark", "Donald", "George",
    "Kenneth", "Steven", "Edward", "Brian", "Ronald", "Anthony",
)

# Replacement last names.
LAST_NAMES = (
    "Smith", "Johnson", "Williams", "Brown", "Jones", "Miller", "Davis", "Garcia",
    "Rodriguez", "Wilson", "Martinez", "Anderson", "Taylor", "Thomas", "Hernandez",
    "Moore",
)

# Three-digit zip areas with too few inhabitants to be shown.
RESTRICTED_ZIP3 = (
    "036", "692", "878", "059", "790", "879", "063", "821", "884", "102", "823", "890",
    "203", "830", "893", "556", "831",
)

# Days of shift by the last digit (0 to 9) of the patient id.
SHIFT_DAYS = (-8, -7, -6, -5, -4, 8, 7, 6, 5, 4)

# Terms of each ethnic group, lower case. Spellings are kept as
# they are found in the data these lists were made for.
HISPANIC_TERMS = (
    "hispanic or latino", "andalusian", "asturian", "aastillian", "catalonian",
    "belearic islander", "gallego", "valencian", "canarian", "spanish basque", "mexican",
    "mexican-american", "mexicano", "chicano", "la raza", "mexican-american indian",
    "central american", "costa rican", "guatemalan", "honduran", "nicaraguan",
    "panamanian", "salvadoran", "central american indian", "canal zone",
    "south american", "argentinean", "bolivian", "chilean", "colombian", "ecuadorian",
    "paraguayan", "peruvian", "uruguayan", "venezuelan", "south american indian",
    "criollo", "latin american", "puerto rican", "cuban", "dominican",
)
ASIAN_TERMS = (
    "afghan", "armenian", "azerbaijani", "bahraini", "bangladeshi", "bhutanese",
    "bruneian", "cambodian", "chinese", "cypriot", "east timorese", "egyptian",
    "georgian", "indian", "indonesian", "iranian", "persian", "iraqi", "israeli",
    "japanese", "jordanian", "kazakhstani", "kuwaiti", "kyrgyz", "lao", "laotian",
    "lebanese", "malaysian", "maldivian", "mongolian", "myanma", "burmese", "nepali",
    "nepalese", "gurkhas", "north korean", "omani", "pakistani", "filipino", "filipina",
    "philippine", "qatari", "russian", "saudi arabian", "singaporean", "south korean",
    "korean", "sri lankan", "syrian arabs", "arameans", "kurds", "turkomans",
    "tajikistani", "thai", "turkish", "turkmen", "emirati", "emiri", "uzbekistani",
    "vietnamese", "yemeni", "asian",
)
PACIFIC_TERMS = (
    "pitcairn islander", "māori", "tokelauan", "tuvaluan", "native hawaiian",
    "polynesian", "tahitians", "togan", "samoan",
)
BLACK_TERMS = (
    "african american", "black", "black american", "west african", "central african",
    "south african", "east african", "caribbean",
)
NATIVE_AMERICAN_TERMS = (
    "american indian", "tsimshian", "aleut", "eskimo", "hadia", "ilingit", "eyak",
    "alaskan athabaskans",
)

# Group labels, in the order in which groups are tried.
ETHNIC_GROUPS = (
    ("Hispanic or Latino", HISPANIC_TERMS),
    ("Asian", ASIAN_TERMS),
    ("Native Hawaiian or Other Pacific Islander", PACIFIC_TERMS),
    ("Black or African American", BLACK_TERMS),
    ("American Indian or Alaska Native", NATIVE_AMERICAN_TERMS),
)
# Fixed value: the third label as older outputs spell it.
PACIFIC_LABEL_COMPAT = "Native Hawaiian orOther Pacific Islander"


# The package's own list of female first names, for use where none is given.
FEMALE_NAMES = (
    "Abigail", "Agnes", "Alice", "Amanda", "Amelia", "Amy", "Andrea", "Angela", "Ann", "Anna",
    "Barbara", "Beatrice", "Betty", "Brenda", "Carla", "Carmen", "Caroline", "Catherine", "Cecilia",
    "Charlotte", "Christine", "Clara", "Claudia", "Cynthia", "Daisy", "Deborah", "Diana", "Donna",
    "Doris", "Dorothy", "Edith", "Eleanor", "Elena", "Elizabeth", "Ella", "Emily", "Emma", "Erica",
    "Esther", "Eva", "Fiona", "Florence", "Frances", "Gloria", "Grace", "Hannah", "Heather", "Helen",
    "Ida", "Irene", "Isabel", "Jane", "Janet", "Jennifer", "Jessica", "Joan", "Julia", "Karen",
    "Laura", "Linda", "Lucy", "Margaret", "Maria", "Martha", "Mary", "Nancy", "Nora", "Olivia",
    "Pamela", "Paula", "Rachel", "Rebecca", "Rosa", "Ruth", "Sandra", "Sarah", "Sofia", "Susan",
    "Teresa", "Victoria", "Virginia",
)


def default_given_names() -> dict[str, tuple[str, ...]]:
    """Built-in first names by gender; pass ``given_names`` for longer lists."""
    return {"female": FEMALE_NAMES, "male": FIRST_NAMES}
