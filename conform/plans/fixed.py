"""The reference data and rules of the pharma mart.

Results depend on each of them, so they are stated as they are.
"""

# The eight drug categories (code, description, class hint, example drug).
ATC_SEED = [
    ("M01AB", "Anti-inflammatory/antirheumatic, non-steroid, acetic acid derivatives",
     "Nonsteroidal Anti-inflammatory Drug", "diclofenac"),
    ("M01AE", "Anti-inflammatory/antirheumatic, non-steroid, propionic acid derivatives",
     "Nonsteroidal Anti-inflammatory Drug", "ibuprofen"),
    ("N02BA", "Other analgesics and antipyretics, salicylic acid and derivatives",
     "Salicylate", "aspirin"),
    ("N02BE", "Other analgesics and antipyretics, pyrazolones and anilides",
     "Anilide / Analgesic", "paracetamol"),
    ("N05B", "Psycholeptics, anxiolytics", "Benzodiazepine / Anxiolytic", "diazepam"),
    ("N05C", "Psycholeptics, hypnotics and sedatives", "Sedative-Hypnotic", "zolpidem"),
    ("R03", "Drugs for obstructive airway diseases", "Bronchodilator / Beta2 Agonist", "salbutamol"),
    ("R06", "Antihistamines for systemic use", "Antihistamine", "loratadine"),
]
ATC_SEED_SCHEMA = "atc_code string, atc_description string, pharm_class_hint string, example_generic string"
ATC_CODES = [row[0] for row in ATC_SEED]

# Calendar of the mart (end exclusive), text of the scrub reason,
# lower and upper bounds of the release checks.
CALENDAR = ("2008-01-01", "2020-01-01")
SCRUB_REASON = "condition: scrape artifact (HTML tag) nulled"
RATING = (1, 10)
NAME_FLOOR = 0.65
CONDITION_FLOOR = 0.90
DROP_TOLERANCE = 0.05
