"""Keyword sets and descriptions of the three journals (J1-J6), as array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: replacements in keyword strings, in the order in which they apply
MMWR_REPLACE = [
    ("&amp;", "&"),
    ("&lt;", "<"),
    (",", ", "),
    (",  ", ", "),
    (", and MMWR", ""),
    (", and fumes", ", fumes"),
    (", and blastomycosis", ", blastomycosis"),
    ("Add article keywords here.", ""),
    ("botulinum toxins A, B, C, D, E, F, and G", "botulinum toxins"),
    ("Hand, Foot, and Mouth Disease", "Hand Foot and Mouth Disease"),
    ("Hand, Foot, And Mouth Disease", "Hand Foot and Mouth Disease"),
    ("Hand, and Mouth Disease", "Hand Foot and Mouth Disease"),
    ("Methamphetamine, Injection Drug, Heroin, And Syphilis", "Methamphetamine Injection Drug Heroin Syphilis"),
    ("STEADI, (Stopping Elderly Accidents, Deaths, and Injuries)", "STEADI (Stopping Elderly Accidents Deaths Injuries)"),
    ("suicidal thoughts, planning, and attempts", "suicidal thoughts planning and attempts"),
    ("suicidal thoughts, and attempts", "suicidal thoughts planning and attempts"),
    ("Washington State Breast, Cervical, and Colon Health Program", "Washington State Breast Cervical Colon Health Program"),
    (", and ", ", "),
    (", And ", ", "),
    ("; ", ", "),
]
EID_REPLACE = [
    ("\n", ", "),
    ("\xad ", "-"),
    ("\u200b", ""),
    ("\\", ""),
    ("Keywords: ", ""),
    ("Keywords:", ""),
    ("<!-- INSERT SHAPE -->Keywords: ", ""),
    (" <!-- INSERT PICT -->", ""),
    (": influenza A virus", ""),
    (", (Borrelia turdi, ", ", Borrelia turdi, "),
    (", Spain), ", ", Spain, "),
    ("(Culebra Cut, Panama Canal)", "(Culebra Cut / Panama Canal)"),
    ("“tâche noire,”", "“tâche noire”,"),
    ("“unassisted by education, and unfettered by the rules of art,” ", "“unassisted by education and unfettered by the rules of art”, "),
]
PCD_REPLACE = [(";", ","), ("\u0092", "’"), ("Key words: ", ""), ("Key Words: ", ""), ("Tianjin, China", "Tianjin China")]
# fixed values: suggested citations, by their number or as far as their commas reach, and names that run on into other words
EID_CITATIONS = [r"Suggested citation for this article:.*?10\.3201/eid\d{4}\.(AC|\d{2})\d{4}", r"Suggested citation for this article:[^,]*?, ([^,]*?, )?([^,]*?, )?([^,]*?, )?([^,]*?, )?[^,]*?(, |\z)"]
PCD_RUN_ONS = {r"\BPreventing Chronic Disease": ",Preventing Chronic Disease", r"NCCDPHP\B": "NCCDPHP,"}
# fixed values: keywords and descriptions that say nothing of the document
MMWR_IGNORE = [
    "", "CDC", "Centers For Disease Control and Prevention", "Centers for Disease Control", "Centers for Disease Control and Prevention", "MMWR",
    "Morbidity & Mortality Weekly Report", "Morbidity and Mortality Report", "Morbidity and Mortality Weekly Report",
]
EID_IGNORE = ["", "CDC", "Centers for Disease Control and Prevention", "Centers for Disease Control and Prevention (U.S.)", "National Center for Immunization and Respiratory Diseases"]
PCD_IGNORE = [
    "", "CDC", "CDC - Wide Page example keywords goes here", "Centers for Disease Control and Prevention", "Centers for Disease Control and Prevention (U.S.)", "NCCDPHP",
    "National Center for Chronic Disease Prevention and Health Promotion", "PCD", "PCD Journal (Preventing Chronic Disease)", "Preventing Chronic Disease",
    "Preventing Chronic Disease Journal", "Preventing Chronic Disease journal", "Preventing Chronic Disease revista",
    "Revista PCD (Preventing Chronic Disease [prevención de enfermedades crónicas])",
]
MMWR_IGNORE_DESC = [
    "Add article description here.",
    "MMWR, Morbidity and Mortality Weekly Report, CDC, Centers for Disease Control and Prevention",
    "The Morbidity and Mortality Weekly Report (MMWR) Recommendations and Reports are prepared by the Centers for Disease Control and Prevention (CDC).",
    "The Morbidity and Mortality Weekly Report (MMWR) Series is prepared by the Centers for Disease Control and Prevention (CDC).",
    "The Morbidity and Mortality Weekly Report (MMWR) Surveillance Summaries are prepared by the Centers for Disease Control and Prevention (CDC).",
    "The Morbidity and Mortality Weekly Report (MMWR) is prepared by the Centers for Disease Control and Prevention (CDC).",
]
PCD_IGNORE_DESC = [
    "CDC - Wide Page example description goes here",
    "Preventing Chronic Disease (PCD) is a peer-reviewed electronic journal established by the National Center for Chronic Disease Prevention and Health Promotion. PCD provides an open exchange of information and knowledge among researchers, practitioners, policy makers, and others who strive to improve the health of the public through chronic disease prevention.",
    "Preventing Chronic Disease (PCD) is a peer-reviewed electronic journal established by the National Center for Chronic Disease Prevention and Health Promotion. PCD provides an open exchange on the very latest in chronic disease prevention, research findings, public health interventions, and the exploration of new theories and concepts.",
]


def chain(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for a, b in pairs:
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def _set(text: Column) -> Column:
    return F.array_distinct(F.transform(F.split(text, ","), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "")))


def mmwr_keywords(text: Column) -> Column:
    """Array of keywords."""
    return F.when((text == "") | text.contains("(CSTE)"), F.array(F.lit(""))).otherwise(_set(chain(text, MMWR_REPLACE)))


def eid_keywords(text: Column) -> Column:
    """Array of keywords; suggested citations go."""
    t = chain(text, EID_REPLACE)
    for pattern in EID_CITATIONS:
        t = F.regexp_replace(t, pattern, "")
    return _set(t)


def pcd_keywords(text: Column) -> Column:
    """Array of keywords; run-on names of the journal are cut off."""
    t = chain(text, PCD_REPLACE)
    for pattern, cut in PCD_RUN_ONS.items():
        t = F.regexp_replace(t, pattern, cut)
    return _set(t)


def joined(*sets: Column, ignore: list[str]) -> Column:
    """Union of sets less those to ignore, sorted, with bars between."""
    union = sets[0]
    for s in sets[1:]:
        union = F.array_union(union, s)
    return F.array_join(F.array_sort(F.array_except(union, F.array(*map(F.lit, ignore)))), "|")


def description(text: Column, ignore: list[str]) -> Column:
    """Empty for boilerplate."""
    return F.when(text.isin(ignore), "").otherwise(text)
