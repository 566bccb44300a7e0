"""Fixed values the results depend on.

These must stay equal to the behaviour being reproduced (column names of the
declaration table, the French section headers and activity-line prefixes, the
code pattern, the evaluation levels, generation settings).  They are stated
here once, in natural order, and imported everywhere else.
"""

# --- fixed values: declaration table columns (id, old code, text, attributes) ---
ID = "liasse_numero"
OLD_CODE = "apet_finale"
TEXT = "libelle"
EXTRACTION_COLUMNS = [
    "liasse_numero",
    "apet_finale",
    "libelle",
    "evenement_type",
    "cj",
    "activ_nat_et",
    "liasse_type",
    "activ_surf_et",
    "activ_sec_agri_et",
    "activ_nat_lib_et",
    "activ_perm_et",
]
# the nine columns that identify an activity once the id and old code are dropped
ATTRIBUTE_COLUMNS = [c for c in EXTRACTION_COLUMNS if c not in (ID, OLD_CODE)]
AGRI_COLUMN = "activ_sec_agri_et"
NATURE_COLUMN = "activ_nat_lib_et"

# --- fixed values: correspondence sheet positions and normalised names ---
CORRESPONDENCE_POSITIONS = {
    "naf08_niv5": 1,
    "naf08_niv4": 3,
    "lib_naf08_niv5": 2,
    "naf25_niv5": 10,
    "naf25_niv4": 5,
    "lib_naf25_niv5": 11,
}
# --- fixed values: explanatory-notes sheet column names ---
NOTES_SHEET_COLUMNS = {
    "Code NAF 2025": "code25",
    "Titre": "title",
    "Note.générale": "note_generale",
    "Comprend": "comprend",
    "Comprend.aussi": "comprend_aussi",
    "Ne.comprend.pas": "ne_comprend_pas",
}
# kinds of note and the sheet columns each kind joins (include joins two, newline separated)
NOTE_KINDS = {
    "include": ["comprend", "comprend_aussi"],
    "not_include": ["ne_comprend_pas"],
    "notes": ["note_generale"],
}

# --- fixed values: activity text lines (French, as in the prompts) ---
AGRI_LINE_PREFIX = "\nPrécisions sur l'activité agricole : "
NATURE_LINE_PREFIX = "\nAutre nature d'activité : "

# --- fixed values: label-document sections ---
DOC_TITLE_SEPARATOR = " : "
DOC_NOTES_HEADER = "## Explications des activités incluses dans la sous-classe\n"
DOC_INCLUDE_HEADER = "## Liste d'exemples d'activités incluses dans la sous-classe\n"
DOC_NOT_INCLUDE_HEADER = "## Liste d'exemples d'activités non incluses dans la sous-classe\n"
RETRIEVED_DOC_PREFIX = "========\n"

# --- fixed values: code pattern, evaluation levels, tri-state rendering ---
QUOTED_CODE_PATTERN = r"'([\d]{2}\.[\d]{2}[A-Z])'"
ACCURACY_LEVELS = [5, 4, 3, 2, 1]
TRI_STATE = ("True", "False", "undefined")

# --- fixed values: generation and retrieval settings ---
MAX_NEW_TOKENS = 100
TEMPERATURE = 0.01
SEED = 2025
LOGPROBS = 1
TOP_K = 5
RERANK_FETCH_K = 35
SHARDS = 3

# --- fixed values: the answers' JSON schema, by strategy (given to the predictor to constrain its output) ---
_ANSWER_FIELDS = {
    "codable": {"type": "boolean"},
    "nace2025": {"anyOf": [{"type": "string"}, {"type": "null"}], "default": None},
    "confidence": {"anyOf": [{"type": "number"}, {"type": "null"}], "default": 0.0},
}
ANSWER_SCHEMAS = {
    "mapping": {
        "type": "object",
        "properties": {
            **_ANSWER_FIELDS,
            "nace08_valid": {"anyOf": [{"type": "boolean"}, {"type": "null"}], "default": None},
        },
        "required": ["codable"],
    },
    "retrieval": {"type": "object", "properties": _ANSWER_FIELDS, "required": ["codable"]},
}
