"""Fixed values. Everything in this file must equal the values the ledger's
record format and extraction rules prescribe; none of it is logic."""

# --- Fixed values: article containers, in the order they are preferred --------
CONTAINER_SELECTORS = (
    ("article", None, None),
    ("div", "class", "entry-content"),
    ("div", "class", "post-content"),
    ("main", None, None),
    ("div", "id", "content"),
    ("div", "class", "content"),
)

# --- Fixed values: text blocks --------------------------------------------------
BLOCK_TAGS = ("p", "h1", "h2", "h3", "li")
STOP_MARKER_PREFIXES = ("conversation", "comments")
STOP_MARKER_TOKENS = ("comment by",)
BOILERPLATE_TOKENS = (
    "subscribe now", "sign in", "create an account", "unlimited online access",
    "get exclusive access", "support local journalists", "daily puzzles",
    "share this story", "advertisement",
)
SECTION_STOP_PREFIXES = ("related:", "you might also like", "more on", "from our partners")
SECTION_STOP_TOKENS = (
    "enjoy insights", "access articles from across canada", "share your thoughts",
    "join the conversation",
)
SUBSTANTIVE_TOKENS = (
    "coroners", "investigation", "harness", "leash", "recovery", "recovered",
    "found", "fell", "died", "death",
)
ANCHOR_WORDS = (
    "slackline", "fell", "died", "death", "fatal", "RCMP", "Coroners", "recovery", "recover",
)
FOCUS_DROP_TOKENS = ("enjoy insights", "access articles from across canada", "share your thoughts")

# --- Fixed values: landing pages ------------------------------------------------
LANDING_TOKENS = (
    "subscribe", "sign up", "get started", "click here", "sponsored",
    "advertisement", "promo", "buy now", "limited time",
)

# --- Fixed values: html metadata keys --------------------------------------------
META_AUTHOR_KEYS = ("author", "article:author", "og:author", "dc.creator", "dc:creator")
META_DATE_KEYS = (
    "article:published_time", "article:modified_time", "og:updated_time",
    "pubdate", "publish_date", "date", "dc.date", "dc.date.issued",
)

# --- Fixed values: calendar words ------------------------------------------------
MONTHS = (
    "january", "february", "march", "april", "may", "june", "july", "august",
    "september", "october", "november", "december",
)
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")

# --- Fixed values: rule-based extraction -----------------------------------------
RESCUE_PATTERNS = ("Search and Rescue", r"SAR\b", r"RCMP\b", r"police\b", "Fire Department", r"EMS\b")
ROUTE_KEYWORDS = (
    "rappel", "rappelling", "couloir", "gully", "ridge", "spire", "face", "wall",
    "crag", "route", "descent", "ascent",
)
EQUIPMENT_KEYWORDS = (
    "piton", "anchor", "pitons", "harness", "leash", "carabiner", "bolt", "gps", "rope",
)
NUMBER_WORDS = (("one", 1), ("two", 2), ("three", 3), ("four", 4), ("five", 5))
MALE_WORDS = ("man", "male", "boy")
FEMALE_WORDS = ("woman", "female", "girl")
WIRE_AGENCIES = ("ap", "reuters")
FEET_TO_METERS = 0.3048
GAZETTEER = (
    "North Cascades", "Garibaldi Provincial Park", "Cheakamus Canyon Recreation Area",
    "Early Winters Spires", "Mount Rainier", "Olympic National Park", "Whistler",
    "Chek Canyon Recreation Area", "Atwell Peak",
)
PUBLISHER_LABELS = (
    ("climbing.com", "Climbing"),
    ("gripped.com", "Gripped"),
    ("gripped.com:443", "Gripped"),
    ("rockandice.com", "Rock and Ice"),
    ("mountainproject.com", "Mountain Project"),
    ("outsideonline.com", "Outside Online"),
    ("outsideonline.com:443", "Outside Online"),
    ("nbcnews.com", "NBC News"),
    ("abcnews.go.com", "ABC News"),
    ("globalnews.ca", "Global News"),
    ("mirror.co.uk", "The Mirror"),
    ("people.com", "People"),
    ("seattletimes.com", "Seattle Times"),
    ("squamishchief.com", "Squamish Chief"),
    ("lakelandtoday.ca", "Lakeland Today"),
    ("cochranenow.com", "CochraneNow"),
    ("rmoutlook.com", "Rocky Mountain Outlook"),
)
TEXT_BUDGETS = (
    ("single", 18000), ("focused", 12000), ("full", 16000), ("excerpt", 600), ("signature", 200),
)

# --- Fixed values: images ---------------------------------------------------------
IRRELEVANT_IMAGE_TOKENS = (
    "logo", "wordmark", "badge", "brand", "promo", "affiliate", "watermark", "trademark",
    "ads", "advert", "avatar", "favicon", "icon", "share", "share-icons", "share-icon",
    "social", "button", "close", "thumb", "thumbnail", "sprite", "inline-icon",
)
STRAY_HOST_TOKENS = ("gravatar.com", "avatar", "favicon")
RELEVANT_CAPTION_WORDS = (
    "rescue", "helicopter", "avalanche", "mountain", "peak", "ridge", "summit", "snow",
    "glacier", "teams", "SAR", "cliff", "fatal", "missing",
)
UPLOAD_PATH = r"/(wp-content|uploads|media|images)/"
IMAGE_EXTENSION = r"\.(jpg|jpeg|png|webp)$"
MIN_IMAGE_WIDTH, MIN_IMAGE_HEIGHT, MIN_IMAGE_BYTES = 300, 200, 4096

# --- Fixed values: ledger columns, in header order --------------------------------
CANONICAL_FIELDS = (
    "extracted_at", "source_url", "article_text", "scraped_full_text",
    "source_name", "article_title", "article_date_published",
    "region", "mountain_name", "route_name", "activity_type", "accident_type",
    "accident_date", "accident_time_approx",
    "num_people_involved", "num_fatalities", "num_injured", "num_rescued",
    "people", "rescue_teams_involved", "response_agencies",
    "rescue_method", "response_difficulties", "bodies_recovery_method",
    "accident_summary_text", "timeline_text",
    "quoted_dialogue", "notable_equipment_details", "local_expert_commentary", "family_statements",
    "photo_urls", "video_urls", "related_articles_urls", "fundraising_links", "official_reports_links",
    "fall_height_meters_estimate", "self_rescue_boolean", "anchor_failure_boolean",
    "extraction_confidence_score",
)
URL_LIST_FIELDS = (
    "photo_urls", "video_urls", "related_articles_urls", "fundraising_links", "official_reports_links",
)
ONE_LINE_FIELDS = ("article_text", "scraped_full_text")

# --- Fixed values: record keys by type ---------------------------------------------
STRING_KEYS = (
    "source_url", "source_name", "article_title", "article_date_published", "region",
    "mountain_name", "route_name", "activity_type", "accident_type", "accident_date",
    "accident_time_approx", "rescue_method", "response_difficulties", "bodies_recovery_method",
    "accident_summary_text", "timeline_text", "notable_equipment_details",
    "local_expert_commentary", "family_statements", "consensus_state",
)
INT_KEYS = ("num_people_involved", "num_fatalities", "num_injured", "num_rescued")
FLOAT_KEYS = ("fall_height_meters_estimate", "extraction_confidence_score", "route_confidence_score")
BOOL_KEYS = ("self_rescue_boolean", "anchor_failure_boolean")
LIST_KEYS = (
    "rescue_teams_involved", "response_agencies", "quoted_dialogue", "photo_urls", "video_urls",
    "related_articles_urls", "fundraising_links", "official_reports_links", "route_candidates",
    "route_aliases", "route_grade_systems", "route_grades", "events", "event_chain_types",
    "anchors", "provenance", "counterfactuals", "related_incident_ids",
)
DICT_KEYS = ("location", "cause_layers", "confidences", "derived_metrics", "activity_specific")
TRUE_WORDS = ("true", "yes", "1")
FALSE_WORDS = ("false", "no", "0")
DATE_KEYS = ("article_date_published", "accident_date", "missing_since", "recovery_date")

# --- Fixed values: cause object. kind is one of enum, int, bool, text, list,
# lower_list (lower-cased, distinct) ------------------------------------------------
PROXIMATE_CAUSES = (
    "anchor_failure", "rope_system_failure", "fall_on_steep_snow", "rockfall", "icefall",
    "avalanche", "crevasse_fall", "weather_change", "visibility_loss", "cornice_collapse",
    "terrain_trap_involvement", "slip_or_trip", "miscommunication", "medical_emergency",
    "equipment_malfunction",
)
CONTRIBUTING_FACTORS = (
    "single_point_anchor", "anchor_old_or_weathered", "no_anchor_backup", "overloaded_anchor",
    "party_all_on_one_rope", "no_fixed_protection", "improper_knots",
    "inadequate_edge_protection", "unroped_on_glacier", "late_in_day",
    "rapid_temperature_change", "storm_arrival", "wind_slab_loading", "poor_visibility",
    "human_factor_heuristic_trap", "route_finding_error", "fatigue", "equipment_left_in_place",
    "improvised_anchor", "technical_skill_mismatch",
)
CAUSE_OBJECTS = {
    "anchor_system": (
        ("anchor_type", "enum", ("piton", "bolt", "gear_anchor", "snow_picket", "bollard",
                                 "v-thread", "tree", "rock_horn", "natural", "unknown")),
        ("num_points", "int", None),
        ("redundancy_present", "bool", None),
        ("anchor_condition", "enum", ("new", "good", "old", "weathered", "rusted", "unknown")),
        ("failure_mode", "enum", ("pulled", "snapped", "sheared", "unknown")),
    ),
    "rope_system": (
        ("num_people_on_rope", "int", None),
        ("roped_for_descent", "bool", None),
        ("roped_for_ascent", "bool", None),
        ("protection_in_place", "bool", None),
        ("rope_type", "enum", ("single", "half", "twin", "static", "unknown")),
        ("belay_method", "enum", ("rappel", "lower", "simul", "pitch", "running_belay",
                                  "short_rope", "unroped")),
        ("failure_description", "text", None),
        ("knots_used", "list", None),
    ),
    "decision_factors": (
        ("objective_hazard_awareness", "enum", ("low", "medium", "high", "unknown")),
        ("time_pressure", "bool", None),
        ("group_dynamics", "enum", ("leader_follower", "peer_pressure", "independent", "unknown")),
        ("experience_level_est", "enum", ("beginner", "intermediate", "advanced", "expert",
                                          "mixed", "unknown")),
        ("weather_forecast_considered", "bool", None),
        ("alternate_plan_available", "bool", None),
    ),
    "equipment_status": (
        ("critical_gear_present", "list", None),
        ("gear_condition_issues", "list", None),
        ("missing_expected_gear", "list", None),
        ("equipment_failure_noted", "list", None),
    ),
    "environmental_conditions": (
        ("weather_change_timing", "enum", ("before", "during", "after", "none", "unknown")),
        ("precipitation_intensity", "enum", ("none", "light", "moderate", "heavy")),
        ("temperature_trend", "enum", ("warming", "cooling", "stable", "unknown")),
        ("wind_speed_est", "enum", ("calm", "moderate", "strong", "storm")),
        ("snowpack_instability_signs", "lower_list", None),
        ("visibility_class", "enum", ("good", "moderate", "poor", "whiteout")),
    ),
    "human_factors": (
        ("group_size", "int", None),
        ("group_experience_mix", "enum", ("homogeneous", "mixed", "unknown")),
        ("communication_method", "lower_list", None),
        ("language_barrier_present", "bool", None),
        ("heuristic_traps_observed", "lower_list", None),
        ("fatigue_level", "enum", ("low", "moderate", "high", "unknown")),
        ("risk_tolerance_inferred", "enum", ("low", "moderate", "high", "unknown")),
    ),
    "rescue_and_outcome": (
        ("rescue_delay_minutes_est", "int", None),
        ("self_rescue_attempted", "bool", None),
        ("remains_recovered", "bool", None),
        ("survivor_condition_notes", "text", None),
        ("body_recovery_difficulty", "enum", ("easy", "moderate", "technical", "high", "unknown")),
    ),
    "investigation_notes": (
        ("investigation_in_progress", "bool", None),
        ("anchor_recovered", "bool", None),
        ("anchor_backup_found", "bool", None),
        ("gear_recovered_description", "text", None),
        ("uncertainties_list", "list", None),
    ),
    "cause_classification": (
        ("primary_cause_category", "enum", ("technical_system_failure", "environmental",
                                            "human_factor", "medical", "unknown")),
        ("secondary_cause_categories", "lower_list", None),
        ("narrative_summary", "text", None),
    ),
}

# --- Fixed values: fusion --------------------------------------------------------
LONGEST_WINS_KEYS = ("accident_summary_text", "timeline_text")
SIDECAR_MAP_KEYS = ("derived_metrics", "activity_specific", "cause_layers")
SIDECAR_LIST_KEYS = ("events", "event_chain", "photo_urls", "video_urls")
SIDECAR_MIN_SCORE = 0.1
CONFLICT_KEYS = ("timeline_text", "accident_summary_text")

# --- Fixed values: reports ---------------------------------------------------------
REQUIRED_META_KEYS = ("title", "event_id")
OPTIONAL_META_KEYS = ("date_of_event", "region", "audience", "area")
AGENCY_FIELDS = ("response_agencies", "rescue_teams_involved", "agencies")
REGION_FIELDS = ("mountain_name", "peak", "area_name", "location", "region")
LIST_ITEM_REQUIRED = ("id", "date", "region", "activity", "title")
PAGE_SIZE = 20

# --- Fixed values: text patterns of the extraction rules ----------------------------
DATE_MENTION = (r"\b(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|jun(?:e)?|jul(?:y)?|aug(?:ust)?|"
                r"sep(?:t(?:ember)?)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)[\s\d,0-9]{2,20}")
NAMED_AGE = r"\b([A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,3}),\s*(\d{1,3})\b"
UNNAMED_AGE = r"\b(\d{1,3})[- ]?year[- ]?old\b(?:\s+([A-Za-z\-]+))?"
KILLED = (r"\b(\d+)\s+killed\b", r"\b(\d+)\s+dead\b")
KILLED_REVERSED = r"\bkilled\s+(\d+)\b"
INJURED = (r"\b(\d+)\s+injured\b", r"(\d+)\s+hurt\b")
AREA = r"\b(?:in|at)\s+([A-Z][\w\s'\-]{3,80}?(?:Area|Park|Recreation|Range|Provincial))"
DIFFICULTY = (r"\b5\.[0-9]{1,2}[a-z]?\b", r"\bclass\s+[1-5]\b", r"\bV\d+\b", r"\bGrade\s+[IV|]\b")
FALL_FEET = r"(\d{2,5})\s*(?:feet|ft|foot)\b"
SLOPE = r"(\d{1,2})\s*(?:degrees?|°)\b"
ASPECT = r"\b(N|NE|E|SE|S|SW|W|NW)\b"
ASPECT_STRICT = r"\b(N|NE|E|SE|S|SW|W|NW)(?:[- ]?facing| aspect)\b"
AUTHOR = (
    r"^(?:by|By)\s+([A-Z][A-Za-z\-']+(?:\s+[A-Z][A-Za-z\-']+){0,4})(?=\b|,)",
    r"(?:^|[\n\-–|•])\s*(?:by|By)\s+([A-Z][A-Za-z\-']+(?:\s+[A-Z][A-Za-z\-']+){0,4})(?=\b|[,|])",
    r"(?:^|\n)\s*(?:by|By)\s+([A-Z][A-Za-z]{2,20})(?=\b|[,|])",
)
DATE_LABEL = (
    r"(?:published|posted|updated|last\s+updated|date|on)[:\s\-]{0,5}"
    r"((?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Sept|Oct|Nov|Dec)[a-z]*\.?(?:\s+\d{1,2})(?:,)?(?:\s+\d{4})?"
    r"|\d{4}-\d{2}-\d{2}"
    r"|\d{1,2}[/-]\d{1,2}[/-]\d{2,4}"
    r"|\d{1,2}\s+(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Sept|Oct|Nov|Dec)[a-z]*\.?,?\s+\d{4})"
)
MONTH_DAY_YEAR = r"((?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Sept|Oct|Nov|Dec)[a-z]*\.?\s+\d{1,2},?\s+\d{4})"
ISO_ANYWHERE = r"\b(\d{4}-\d{2}-\d{2})\b"

# --- Fixed values: patterns of pages, blocks, images, reports and their list -----
PAGE_BYLINE = r"(?U)(?:^|[\n\-–|•])\s*(?:By|BY)\s+([A-Z][A-Za-z\-']+(?:\s+[A-Z][A-Za-z\-']+){0,4})"
# Scripts near the top of a page that are looked at for a redirect.
REDIRECT_SCRIPTS = 6
JS_REDIRECT = r"(?i)location\.href\s*=|location\.replace\(|window\.location"
PEAK = r"(?i)^peak/area\s*[:\-]\s*(.+)$"
ACTIVITY = r"(?i)^activity/style\s*[:\-]\s*(.+)$"
MANIFEST_ID = r"(?i)^[a-f0-9]{6,}$"
REPORT_ID = r"(?i)^[a-z0-9]{4,}$"
SUMMARY_SECTION = r"(?is)## Executive Summary(.*?)(?:\n##|\z)"
BLOCK_BYLINE = r"(?U)^(author\b|by\s+[A-Z][\w\-']+)"
HEADLINE = r"(?U)^[A-Z][\w\s'’:-]+$"
SIGN_UP = r"(?is)By signing up.*?(?=\n\n|\z)"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
IMAGE_URL_IN_TEXT = r"https?://[^\s\"'>)]+"
UPLOAD_IN_TEXT = r"https?://[^\s\"'>)]+wp-content/uploads[^\s\"'>)]+"
URL_IN_TEXT = r"https?://[^\s)]+"
SOURCES_SECTION = r"(?s)## Sources\n.*?(?=\n## |\z)"
SOURCES_NOTE = "(All original source URLs listed above; labels inferred from domains.)"
