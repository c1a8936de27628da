"""The schema of a chunk's metadata and the fixed values that results depend on."""

from __future__ import annotations

METADATA = (
    "STRUCT<ipb_step: INT, content_type: STRING, echelon: STRING, domain: STRING, threat_type: STRING, "
    "ipb_product: STRING, environment: STRING, doctrinal_weight: DOUBLE>"
)

# ---------------------------------------------------------------------------
# Fixed values. Results must equal these tables, patterns and formats.
# ---------------------------------------------------------------------------

#: Chapter or appendix: title, step (or None), weight.
CHAPTERS = {
    "1": ("IPB Fundamentals", 0, 2.5),
    "2": ("IPB Support to Planning", 0, 2.0),
    "3": ("Step 1—Define the Operational Environment", 1, 2.0),
    "4": ("Step 2—Describe Environmental Effects", 2, 2.0),
    "5": ("Step 3—Evaluate the Threat", 3, 2.5),
    "6": ("Step 4—Determine Threat COAs", 4, 2.5),
    "7": ("Unified Action and Unique Environments", None, 3.0),
    "8": ("Multi-Domain Considerations", None, 2.0),
    "A": ("Intelligence Products", None, 1.5),
    "B": ("Intelligence Synchronization", None, 1.5),
    "C": ("Threat Evaluation", 3, 2.0),
    "D": ("Course of Action Analysis", 4, 1.5),
}
DEFAULT_WEIGHT = 1.5

STEP_LABELS = {
    0: "IPB Fundamentals",
    1: "Step 1—Define the Operational Environment",
    2: "Step 2—Describe Environmental Effects on Operations",
    3: "Step 3—Evaluate the Threat",
    4: "Step 4—Determine Threat Courses of Action",
}
NO_STEP_LABEL = "General IPB"

#: Metadata field: allowed values, default.
VOCABULARY = {
    "content_type": (("doctrine", "procedure", "example", "reference", "product"), "doctrine"),
    "echelon": (("national", "theater_army", "corps", "division", "bct", "battalion", "general"), "general"),
    "domain": (("land", "air", "sea", "space", "cyber", "multi", "general"), "general"),
    "threat_type": (("conventional", "unconventional", "hybrid", "general"), "general"),
    "ipb_product": (("modified_combined_obstacle_overlay", "event_template", "situation_template", "threat_model", "none"), "none"),
    "environment": (("competition", "crisis", "armed_conflict", "lsco", "general"), "general"),
}

#: Keyword (a substring of the lower-cased text) and value; the first hit counts.
KEYWORDS = {
    "echelon": (
        ("theater army", "theater_army"),
        ("corps", "corps"),
        ("division", "division"),
        ("brigade combat team", "bct"),
        ("bct", "bct"),
        ("battalion", "battalion"),
    ),
    "domain": (
        ("cyber", "cyber"),
        ("space", "space"),
        ("air", "air"),
        ("maritime", "sea"),
        ("sea", "sea"),
        ("multi-domain", "multi"),
    ),
    "environment": (
        ("large-scale combat", "lsco"),
        ("lsco", "lsco"),
        ("armed conflict", "armed_conflict"),
        ("crisis", "crisis"),
        ("competition", "competition"),
    ),
}

#: Question type: draw weight, target share in percent, prefix of question ids.
QUESTION_TYPES = {
    "factual": (1.0, 15, "F"),
    "procedural": (1.5, 15, "P"),
    "comparative": (1.5, 10, "C"),
    "echelon_specific": (2.0, 10, "E"),
    "applied_reasoning": (1.5, 20, "AR"),
    "product_generation": (1.5, 10, "PG"),
    "cross_step": (1.5, 10, "CS"),
    "multi_domain": (1.5, 5, "MD"),
    "contrastive": (2.0, 5, "CT"),
}

#: The manual whose citations the validation patterns look for.
MANUAL = "ATP 2-01.3"
CITATION_PATTERN = r"(?i)\[Reference:\s*ATP\s+2-01\.3"
BAD_OPENING_PATTERN = r"(?i)^According to ATP"
BAD_OPENING_LOOSE_PATTERN = r"(?i)^\s*According to ATP"
PARA_REFERENCE_PATTERN = r"(?i)\bpara(?:graph)?\s+\d+-\d+"
CROSS_REFERENCE_PATTERN = r"(?i)\bparagraph[s]?\s+(\d+-\d+)"
FIGURE_PATTERN = r"(?i)\bfigure\s+\d+-\d+"
PARA_START_PATTERN = r"^(\d+)-(\d+)\.\s+"
APPENDIX_START_PATTERN = r"^([A-D])-(\d+)\.\s+"
NOISE_PATTERNS = (
    r"ATP 2-01\.3\s+\d{1,2}\s+\w+\s+\d{4}",
    r"\d{1,2}\s+\w+\s+\d{4}\s+ATP 2-01\.3",
    r"(?m)^Figure \d+[-–]\d+\..*",
    r"(?m)^Table \d+[-–]\d+\..*",
    r"\(See figure \d+[-–]\d+\.\)",
    r"\(See table \d+[-–]\d+\.\)",
    r"(?i)Intentionally left blank",
)
MIN_CHUNK_WORDS, MAX_CHUNK_WORDS = 20, 500
LOOKBACK_LINES = 25
MIN_QUESTION_WORDS, MIN_ANSWER_WORDS, MAX_TRACE_WORDS = 20, 50, 500
WEAK_SCORE, PENALTY = 0.5, 0.1
FIXED_REJECTED = "I don't have specific information about that doctrine."
MIN_REJECTED_WORDS = 10
SEED_NUMBER = 42

#: JSON inside free text: a fenced block, a flat object, one nested once.
JSON_FENCE = r"(?s)```json\s*(.*?)\s*```"
JSON_FLAT = r"(?s)\{[^{}]+\}"
JSON_NESTED = r"(?s)\{[^{}]*(?:\{[^{}]*\}[^{}]*)?\}"

#: Header lines of prompts; the leak rule looks for them.
SINGLE_PROMPT = "SOURCE TEXT (%s %s: %s, Para %s, Echelon: %s):\n%s\n\nTASK: %s\n"
PAIR_PROMPT = "SOURCE A (%s %s: %s, Para %s, Echelon: %s):\n%s\n\nSOURCE B (%s %s: %s, Para %s, Echelon: %s):\n%s\n\nTASK: %s\n"
