"""Code tables of the census person records."""

from __future__ import annotations

# --- Fixed values: they must equal the published code tables -----------------

FIELD_NAMES = {
    "AGEP": "age",
    "SCHL": "education",
    "OCCP": "occupation",
    "WKHP": "hours_per_week",
    "COW": "class_of_worker",
    "MAR": "marital_status",
    "PWGTP": "person_weight",
    "WAGP": "wage_income",
    "RAC1P": "race",
    "SEX": "sex",
    "NATIVITY": "nativity",
}

RACE = {
    "1": "White alone",
    "2": "Black or African American alone",
    "3": "American Indian alone",
    "4": "Alaska Native alone",
    "6": "Asian alone",
    "7": "Native Hawaiian / Pacific Islander alone",
    "8": "Some other race alone",
    "9": "Two or more races",
}

SEX = {"1": "Male", "2": "Female"}

NATIVITY = {"1": "Native born", "2": "Foreign born"}

EDUCATION = {
    "1": "No schooling",
    "2": "Nursery school",
    "3": "Grade 1",
    "4": "Grade 2",
    "5": "Grade 3",
    "6": "Grade 4",
    "7": "Grade 5",
    "8": "Grade 6",
    "9": "Grade 7",
    "10": "Grade 8",
    "11": "Grade 9",
    "12": "Grade 10",
    "13": "Grade 11",
    "14": "Grade 12 (no diploma)",
    "15": "High school diploma",
    "16": "GED",
    "17": "Some college (<1yr)",
    "18": "Some college (>1yr)",
    "19": "Associate degree",
    "20": "Bachelor's degree",
    "21": "Master's degree",
    "22": "Professional degree",
    "23": "Doctorate",
    "24": "No schooling (older code)",
}

OCCUPATION = {
    "10": "Management",
    "100": "Business Operations",
    "200": "Finance",
    "300": "Computer & Math",
    "400": "Architecture & Engineering",
    "500": "Science",
    "600": "Social Services",
    "700": "Legal",
    "800": "Education",
    "900": "Arts & Entertainment",
    "1000": "Healthcare (Practitioner)",
    "1100": "Healthcare (Support)",
    "1200": "Protective Services",
    "1300": "Food Prep",
    "1400": "Building & Grounds",
    "1500": "Personal Care",
    "1600": "Sales",
    "1700": "Office & Admin",
    "1800": "Farming",
    "1900": "Construction",
    "2000": "Extraction",
    "2100": "Installation & Repair",
    "2200": "Production",
    "2300": "Transportation",
    "2400": "Material Moving",
}

CLASS_OF_WORKER = {
    "1": "Private for-profit (employee)",
    "2": "Private non-profit (employee)",
    "3": "Local government",
    "4": "State government",
    "5": "Federal government",
    "6": "Self-employed (not inc.)",
    "7": "Self-employed (inc.)",
    "8": "Family business (unpaid)",
    "9": "Unemployed",
}

MARITAL_STATUS = {
    "1": "Married",
    "2": "Widowed",
    "3": "Divorced",
    "4": "Separated",
    "5": "Never married",
}

NUMERIC_FIELDS = (
    "age",
    "education",
    "hours_per_week",
    "wage_income",
    "class_of_worker",
    "marital_status",
    "person_weight",
)

# --- End of fixed values -------------------------------------------------------

CENSUS_DIMS = {"race": RACE, "sex": SEX, "nativity": NATIVITY}
