"""Labels, slugs, header texts, markers and palettes.

Everything in this module is a constant of the published data sets or of the
expected output. Combination tables are derived by rule, never listed.
"""

# --- fixed values: incident types and the slug each one counts under ---------
CRIME_TYPES = {
    "": "EMPTYNULLCrime",
    "Anti-social behaviour": "AntiSocialBehavior",
    "Bicycle theft": "BicycleTheft",
    "Burglary": "Burglary",
    "Criminal damage and arson": "CriminalDamageArson",
    "Drugs": "Drugs",
    "Other crime": "OtherCrime",
    "Other theft": "OtherTheft",
    "Possession of weapons": "PossessionWeapons",
    "Public disorder and weapons": "PublicDisorderWeapons",
    "Public order": "PublicOrder",
    "Robbery": "Robbery",
    "Shoplifting": "Shoplifting",
    "Theft from the person": "TheftFromPerson",
    "Vehicle crime": "VehicleCrime",
    "Violence and sexual offences": "ViolenceSexualOffences",
    "Violent crime": "ViolentCrime",
}

# --- fixed values: outcomes and the slug each one counts under ---------------
OUTCOMES = {
    "": "EMPTYNULLOutcome",
    "Action to be taken by another organisation": "ActionToBeTakenOtherOrg",
    "Awaiting court outcome": "AwaitingCourtOutcome",
    "Court case unable to proceed": "CourtCaseUnableToProceed",
    "Court result unavailable": "CourtResultUnavailable",
    "Defendant found not guilty": "DefendantNotGuilty",
    "Defendant sent to Crown Court": "DefendantSentCrownCourt",
    "Formal action is not in the public interest": "FormalActionNotPublicInterest",
    "Investigation complete; no suspect identified": "InvestigationCompleteNoSuspect",
    "Local resolution": "LocalResolution",
    "Offender deprived of property": "OffDeprivedProperty",
    "Offender fined": "OffFined",
    "Offender given a caution": "OffGivenCaution",
    "Offender given a drugs possession warning": "OffGivenDrugsPossessionWarning",
    "Offender given absolute discharge": "OffGivenAbsoluteDischarge",
    "Offender given community sentence": "OffGivenCommunitySentence",
    "Offender given conditional discharge": "OffGivenConditionalDischarge",
    "Offender given penalty notice": "OffGivenPenaltyNotice",
    "Offender given suspended prison sentence": "OffGivenSuspendedPrisonSentence",
    "Offender ordered to pay compensation": "OffOrderedPayCompensation",
    "Offender otherwise dealt with": "OffOtherwiseDealtWith",
    "Offender sent to prison": "OffSentPrison",
    "Suspect charged as part of another case": "SuspectChargedPartOfAnotherCase",
    "Unable to prosecute suspect": "UnableProsecuteSuspect",
    "Under investigation": "UnderInvestigation",
}

# --- fixed values: the header line of each record kind -----------------------
HEADERS = {
    "street": (
        "Crime ID,Month,Reported by,Falls within,Longitude,Latitude,Location,"
        "LSOA code,LSOA name,Crime type,Last outcome category,Context"
    ),
    "outcomes": (
        "Crime ID,Month,Reported by,Falls within,Longitude,Latitude,Location,"
        "LSOA code,LSOA name,Outcome type"
    ),
    "stop-and-search": (
        "Type,Date,Part of a policing operation,Policing operation,Latitude,"
        "Longitude,Gender,Age range,Self-defined ethnicity,"
        "Officer-defined ethnicity,Legislation,Object of search,Outcome,"
        "Outcome linked to object of search,"
        "Removal of more than just outer clothing"
    ),
}
CROSSWALK_HEADER = "OA11CD,LSOA11CD,LSOA11NM,MSOA11CD,MSOA11NM,LAD11CD,LAD11NM,LAD11NMW"

# --- fixed values: rate table headers, markers and the summary row -----------
RATE_COLUMNS = {
    "local authority: district / unitary (prior to April 2015)": "district",
    "Date": "year",
    "Unemployment rate - aged 16-64": "rate",
    "Denominator": "population",
}
RATE_DROP_PATTERN = r"(Conf|Numerator|Denominator)"
RATE_MARKERS = ("!", "-", "~", "*", "#")
RATE_TOTAL_ROW = "Column Total"

# --- fixed values: map palettes and class limits -----------------------------
RATE_BAND_COLOURS = ("#d5edff", "#6daaee", "#3858f9", "#043c9a")
FIXED_BAND_COLOURS = ("#d5edff", "#6daaee", "#3858f9", "#002566")
COUNT_BAND_COLOURS = ("#f6a0a0", "#ff4b4b", "#fe0100", "#990100")
CYCLE_COLOURS = ("#F1EEF6", "#D4B9DA", "#C994C7", "#DF65B0", "#DD1C77", "#980043")
EQUAL_WIDTH_COLOURS = (
    "#87CEFA", "#6495ED", "#4682B4", "#4169E1",
    "#0000FF", "#0000CD", "#483D8B", "#00008B",
)
MISSING_COLOUR = "black"
UNCLUSTERED_COLOUR = "white"
FIXED_RATE_MEAN = 6.7
FIXED_RATE_SD = 2.9
