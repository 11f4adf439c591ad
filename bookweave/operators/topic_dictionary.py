"""The default topic dictionary: classes of a library classification's outline and the catalogue subjects that name them."""

from __future__ import annotations

#: Each class with its subjects.
CLASSES = {
    "GENERAL WORKS": [
        "Encyclopedias and dictionaries",
        "Newspapers",
        "Periodicals",
    ],
    "PHILOSOPHY. PSYCHOLOGY. RELIGION": [
        "Philosophy",
        "Theology",
        "Logic",
        "Psychology",
        "Aesthetics",
        "Ethics",
        "Mythology",
        "Rationalism",
        "Judaism",
        "Islam",
        "Theosophy",
        "Buddhism",
        "Christianity",
    ],
    "AUXILIARY SCIENCES OF HISTORY": [
        "Archaeology",
        "Numismatics",
        "Heraldry",
        "Genealogy",
        "Biography",
    ],
    "WORLD HISTORY AND HISTORY OF EUROPE, ASIA, AFRICA, AUSTRALIA, NEW ZEALAND, ETC.": [
        "World history",
    ],
    "HISTORY OF THE AMERICAS": [
        "Indians of South America",
        "Indians of North America",
    ],
    "GEOGRAPHY. ANTHROPOLOGY. RECREATION": [
        "Geography",
        "Cartography",
        "Anthropology",
        "Folklore",
        "Manners and customs",
        "Oceanography",
        "Atlases",
        "Mathematical geography",
    ],
    "SOCIAL SCIENCES": [
        "Social sciences",
        "Statistics",
        "Commerce",
        "Finance",
        "Sociology",
        "Socialism",
        "Communism",
        "Anarchism",
        "Criminology",
    ],
    "POLITICAL SCIENCE": [
        "Political science",
        "Democracy",
        "Local government",
        "Municipal government",
        "International relations",
        "Representative government and representation",
    ],
    "LAW": [
        "Law",
        "Civil law",
        "Criminal law",
        "Constitutional law",
        "Commercial law",
        "Maritime law",
        "Administrative law",
        "Military law",
        "Mining law",
        "Corporation law",
        "Educational law and legislation",
        "Labor laws and legislation",
        "Railroad law",
        "Fishery law and legislation",
        "Banking law",
        "Marriage law",
        "Liquor laws",
        "Insurance law",
        "Customary law",
        "Patent laws and legislation",
        "Building laws",
        "Press law",
        "Emigration and immigration law",
    ],
    "EDUCATION": [
        "Education",
        "Textbooks",
    ],
    "MUSIC AND BOOKS ON MUSIC": [
        "Music",
        "Piano music",
        "Music theory",
        "Musical notation",
        "Orchestral music",
    ],
    "FINE ARTS": [
        "Architecture",
        "Sculpture",
        "Drawing",
        "Painting",
        "Decorative arts",
    ],
    "LANGUAGE AND LITERATURE": [
        "Philology",
        "Classical philology",
        "Oriental philology",
        "Romance philology",
        "Russian philology",
        "Greek philology",
        "Language and languages",
        "English language",
        "French language",
        "German language",
        "Latin language",
        "Greek language",
        "Hebrew language",
        "Spanish language",
        "Italian language",
        "Arabic language",
        "Sanskrit language",
        "Chinese language",
        "Indo-European languages",
        "Russian language",
        "Dutch language",
        "Portuguese language",
        "Swedish language",
        "Irish language",
        "Japanese language",
        "Syriac language",
        "Romance languages",
        "Old Norse language",
        "Literature",
        "English literature",
        "French literature",
        "Italian literature",
        "American literature",
        "Russian literature",
        "Spanish literature",
        "Greek literature",
        "Chinese literature",
        "Latin literature",
        "Polish literature",
        "Comparative literature",
        "Children's literature",
    ],
    "SCIENCE": [
        "Science",
        "Mathematics",
        "Astronomy",
        "Physics",
        "Chemistry",
        "Geology",
        "Natural history",
        "Biology",
        "Botany",
        "Zoology",
        "Physiology",
        "Human anatomy",
    ],
    "MEDICINE": [
        "Medicine",
        "Pathology",
        "General Surgery",
        "Ophthalmology",
        "Gynecology",
        "Obstetrics",
        "Pediatrics",
        "Dentistry",
        "Dermatology",
        "Therapeutics",
        "Pharmacology",
        "Pharmacy",
        "Homeopathy",
    ],
    "AGRICULTURE": [
        "Agriculture",
        "Horticulture",
        "Forests and forestry",
        "Hunting",
    ],
    "TECHNOLOGY": [
        "Technology",
        "Engineering",
        "Civil engineering",
        "Electrical engineering",
        "Electric engineering",
        "Mechanical engineering",
        "Mining engineering",
        "Hydraulic engineering",
        "Steam engineering",
        "Home economics",
    ],
    "MILITARY SCIENCE": [
        "Artillery",
        "Military engineering",
        "Infantry drill and tactics",
    ],
    "NAVAL SCIENCE": [
        "Naval art and science",
        "Naval architecture",
        "Shipbuilding",
        "Marine engineering",
    ],
    "BIBLIOGRAPHY. LIBRARY SCIENCE. INFORMATION RESOURCES (GENERAL)": [
        "Library science",
        "Bibliography",
        "Paleography",
    ],
}

TOPICS = {subject: name for name, subjects in CLASSES.items() for subject in subjects}
