"""Literals that results depend on. Callers may override each through plan arguments."""

# Campaign registry.
CAM_REVIEW_REQUEST = 1
CAM_EXISTING_CUSTOMER_CALL = 2
CAM_EXISTING_CUSTOMER_MAIL = 3
CAM_WEEKLY_DE = 4
CAM_WEEKLY_CH = 6
CAM_SECOND_STATUS_SURVEY = 8
CAM_SECOND_TRY = 56

ACCEPTOR_PHONE = "bd_nachtelefonie"

CATEGORY_CALL = "Anrufaktion"
CATEGORY_WEEKLY = "Regelprozess"
OPEN_END = "2999-12-31"
CAMPAIGN_DESCRIPTION = "extra call campaign for our follow ups - {}"

# Review requests.
REVIEW_MAIL_DOMAINS = ("@gmail.com", "@googlemail.com")
REVIEW_EXCLUDED_PAYERS = (
    "Allianz Private Krankenversicherungs-AG",
    "DAK-Gesundheit",
    "Generali Health Solutions GmbH (GHS) (Unternehmenskunden)",
    "Generali Mobile Health App",
    "Generali Versicherung AG",
    "Pronova BKK",
)
REVIEW_EXCLUDED_REASONS = (
    "%Keine weitere Befragung%",
    "%Befragung unangebracht%",
    "%Interner Grund%",
    "%Sonstig%",
)
VIP_VOUCHER = "VRTC"

# Existing-customer mail.
MAIL_EXCLUDED_PAYERS = (
    "Allianz Unfall/Haftpflicht",
    "Allianz Private Krankenversicherungs-AG",
    "BIG direkt gesund",
    "Generali Versicherung AG",
    "Generali Health Solutions GmbH (GHS) (Unternehmenskunden)",
    "Generali Mobile Health App",
    "AOK Plus",
    "Audi BKK",
    "Versicherungskammer Bayern",
    "Versicherungskammer Bayern bKV",
    "mhplus Krankenkasse",
    "DAK-Gesundheit",
    "AOK Hessen",
    "IKK - Die Innovationskasse",
    "Mobil Krankenkasse",
    "bkk melitta hmr",
    "energie-BKK",
    "Salus BKK",
    "Inter Versicherungsgruppe",
)

# Existing customers from the case cube.
DETRACTOR_SCORES = (0, 2, 3, 4, 5, 6)
GOODWILL_VOUCHERS = ("KULANZ-MSSNICHTKOOPP", "GADS-LF22")
CUBE_EXCLUDED_PAYERS = ("%Allianz%", "%BIG%", "%Generali%", "AOK Plus", "%Audi BKK%")
CUBE_EXCLUDED_CHANNELS = ("proactive_steering",)
CUBE_ALLOWED_REASONS = (
    "Befragung vollständig durchgeführt",
    "Patient mehrfach nicht erreicht",
    "Spezialist nicht aufgesucht - Patient meldet sich bei Bedarf",
)
ONLINE_CHANNELS = ("online_marketing", "partner_funnel")

# Existing customers of both case systems.
UNIFIED_MAIN_REASONS = (
    "survey_inappropriate",
    "survey_aborted_by_patient",
    "patient_not_contactable",
    "employee_request",
    "internal_reason",
    "other",
    "Befragung unangebracht - Sonstige",
    "Interner Grund - Kunde, keine Befragung",
    "Interner Grund - Sonstige",
    "Keine weitere Befragung gewünscht",
    "Patient mehrfach nicht erreicht",
    "Sonstige",
    "Spezialist nicht aufgesucht - Entfernung nicht passend",
)
UNIFIED_ADDITIONAL_REASONS = (
    "patient_difficult",
    "patient_critically_ill_or_dead",
    "cost_for_physician",
    "not_satisfied_with_recommendations_had_other_expectations_regarding_the_service",
    "distance_does_not_match",
    "problems_making_an_appointment",
    "b2b_no_survey",
    "test_inquiry",
    "rerun",
    "doc_inquiry",
    "other",
)
UNIFIED_EXCLUDED_VOUCHERS = (
    "AX91-FLA3",
    "ruecken2015",
    "AXAU-CM11",
    "AXAU-22GS",
    "AXAP-22GS",
    "ARAG-CM22",
    "NUBU-7777",
)
UNIFIED_EXCLUDED_CLIENTS = (
    "Allianz Private Krankenversicherungs-AG",
    "Generali Versicherung AG",
    "BIG direkt gesund",
)
UNIFIED_EXCLUDED_INSURANCES = ("Allianz Private Krankenversicherung", "BIG direkt gesund")
UNIFIED_EXCLUDED_GROUPS = ("vip", "other", "swiss_kv")
UNIFIED_INSURANCE_GROUPS = ("gkv", "pkv", "corporate")
PROMOTER_TEXT_SCORES = ("10", "9", "8", "7")
EMPLOYEE_VOUCHER = "%MA4L%"

# Simple existing-customer lists.
SIMPLE_A_EXCLUDED_BRANDS = (
    "%Allianz%",
    "%BKK24%",
    "%IKK - Die Inno%",
    "%Patientenclub%",
    "%VIP%",
    "%HDI%",
)
SIMPLE_A_EXCLUDED_VOUCHERS = ("%MA4L%", "DAK1-LA3F", "DAK-RZM-LEAD", "DAKG-MSSNACHRSO")
SIMPLE_B_EXCLUDED_CLIENTS = ("%Allianz%", "%Assura%", "%VIP%", "%Promo%", "%Test%", "%Patient%")
SIMPLE_B_EXCLUDED_VOUCHERS = (
    "B1-L7 KULANZ",
    "AX91-FLA3",
    "ARAG-CM22",
    "AXAU-22GS",
    "AXAP-22GS",
)

# Telephone follow-up of inquiries.
WEEKLY_TREATMENTS = ("second_opinion_before_surgery", "surgery")
WEEKLY_EXCLUDED_CLIENTS = ("VIP GELB", "VIP ROT")
WEEKLY_EXCLUDED_VOUCHERS = ("%-MSSNACHRSO", "%-BDTC", "NUBU-7777", "%AXAP-%", "ARAG-CM22")
CALL_EXCLUDED_VOUCHERS = ("%-MSSNACHRSO", "%-BDTC", "NUBU-7777")
POSTAL_STATES = ("waiting_q3", "waiting_q4", "waiting_q5", "waiting_q6")
POSTAL_CLIENT = "DAK"
POSTAL_EXCLUDED_CLIENT = "AXA Haftpflichtversicherung"
SECOND_TRY_MAIN_REASONS = (
    "survey_inappropriate",
    "survey_aborted_by_patient",
    "patient_did_not_visit_recommended_physician",
    "employee_request",
    "patient_not_contactable",
    "survey_completed",
)
SECOND_TRY_ADDITIONAL_REASONS = (
    "patient_critically_ill_or_dead",
    "patient_difficult",
    "doc_inquiry",
    "not_satisfied_with_recommendations_had_other_expectations_regarding_the_service",
    "got_recommendations_as_precaution",
    "free_of_pain",
    "treated_by_a_non_bd_physician",
    "b2b_no_survey",
    "test_inquiry",
)

# Surveys and workflow events.
FOLLOW_UP_TITLE = "%Nachbefragung%"
CLOSE_REASONS = ("%Keine weitere Befragung%", "%Befragung unangebracht%", "%Kontaktadresse%")
SWISS_SURVEY_PAYERS = (
    "%ÖKK%",
    "%EGK%",
    "%Helsana%",
    "%Atupri%",
    "Aquilana%",
    "CSS%",
    "Agrisano%",
    "KPT%",
)
# The older card list.
SWISS_LIST_PAYERS = ("%ÖKK%", "%EGK%", "Sanitas%", "%Helsana%", "%Atupri%")
SWISS_POSTAL_PAYERS = SWISS_SURVEY_PAYERS + ("%Assura%", "%Visana%")
PRODUCT_EVENTS = (
    ("MSS", "Spezi%"),
    ("MSS_%", "Weit%"),
    ("RSO", "%Remote%"),
    ("SPC", "Frei%"),
    ("%PMS%", "Erst%"),
)
PROM_PAYER = "%Assura%"
