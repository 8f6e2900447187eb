"""Limits, price list, rule catalogue, histogram bounds.

These must equal the values of the system whose results are matched, so they are
kept together as plain text. Every operator takes them as overridable parameters.
"""

from __future__ import annotations

# --- fixed values: prices, USD per 1000 tokens (provider, model, prompt, completion)
PRICES = [
    ("openai", "gpt-4", 0.03, 0.06),
    ("openai", "gpt-4-turbo-preview", 0.01, 0.03),
    ("openai", "gpt-3.5-turbo", 0.0015, 0.002),
    ("openai", "gpt-4o-mini", 0.00015, 0.0006),
    ("gemini", "gemini-pro", 0.0005, 0.0015),
    ("gemini", "gemini-pro-vision", 0.001, 0.002),
    ("gemini", "gemini-1.5-pro", 0.00125, 0.005),
    ("gemini", "gemini-1.5-flash", 0.000075, 0.0003),
    ("gemini", "gemini-2.5-flash-lite", 0.000075, 0.0003),
]
DEFAULT_PROVIDER = "openai"
DEFAULT_MODELS = {"openai": "gpt-4o-mini", "gemini": "gemini-2.5-flash-lite"}
FALLBACK_MODEL = "gpt-3.5-turbo"
FALLBACK_ORDER = ["openai", "gemini"]

# --- fixed values: A/B variants (name, provider, model, percentage)
VARIANTS = [
    ("openai_gpt4", "openai", "gpt-4", 50),
    ("gemini_pro", "gemini", "gemini-pro", 50),
]

# --- fixed values: admission limits (tier, per minute, per hour)
DEFAULT_TIER = "default"
TIERS = [
    ("default", 60, 1000),
    ("premium", 300, 10000),
]
MINUTE_SECONDS = 60
HOUR_SECONDS = 3600

# --- fixed values: budgets
DEFAULT_BUDGET_LIMIT = 1000.0
DEFAULT_BUDGET_PERIOD = "monthly"
ALERT_THRESHOLDS = [0.5, 0.75, 0.9]

# --- fixed values: cache and masking
CACHE_TTL_SECONDS = 3600
CACHE_THRESHOLD = 0.85
SIMILARITY_THRESHOLD = 0.95
MASK_TTL_SECONDS = 3600

# --- fixed values: token and cost estimates
TOKENS_PER_WORD = 1.3
USD_PER_TOKEN = 0.000002
TOKENS_PER_MESSAGE = 3
TOKENS_PER_REPLY = 3
PROMPT_SHARE = 0.6
COMPLETION_SHARE = 0.4

# --- fixed values: histogram upper bounds
DURATION_BOUNDS = [0.1, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0, 60.0]
TOKEN_BOUNDS = [100.0, 500.0, 1000.0, 2000.0, 5000.0, 10000.0, 20000.0]
COST_BOUNDS = [0.001, 0.01, 0.05, 0.1, 0.5, 1.0, 5.0]

# --- fixed values: webhooks
EVENT_NAMES = ["request.completed", "request.failed", "budget.exceeded", "guardrail.violated"]
WEBHOOK_ATTEMPTS = 3
WEBHOOK_RETRY_SECONDS = 1.0

# --- fixed values: guardrail rules, built-in then custom
BUILTIN_RULES = [
    {"name": "max_tokens", "type": "threshold", "enabled": True, "severity": "error",
     "action": "block", "threshold": 10000},
    {"name": "no_pii_in_output", "type": "pii", "enabled": True, "severity": "error",
     "action": "block", "entity_types": ["TCKN", "CREDIT_CARD", "IBAN"]},
    {"name": "content_filter", "type": "content", "enabled": True, "severity": "warning",
     "action": "log", "patterns": [".*violence.*", ".*hate.*"]},
]
CUSTOM_RULES = [
    {"name": "custom_max_cost", "type": "threshold", "enabled": True, "severity": "error",
     "action": "block", "description": "Stop whatever costs more than this",
     "threshold": 0.10},
    {"name": "custom_pii_detection", "type": "pii", "enabled": True, "severity": "warning",
     "action": "log", "description": "Note addresses and numbers in prompts",
     "entity_types": ["EMAIL", "PHONE"], "threshold": 1},
    {"name": "custom_content_safety", "type": "content", "enabled": False,
     "severity": "warning", "action": "log", "description": "Words that need a second look",
     "patterns": [".*sensitive.*", ".*confidential.*"]},
]

# --- fixed values: entity types in detection order, and tagger labels
# (label, entity type, confidence)
REGEX_TYPES = ["TCKN", "PHONE", "EMAIL", "IBAN", "CREDIT_CARD", "AMOUNT"]
NER_LABELS = [
    ("PERSON", "PERSON", 0.8),
    ("ORG", "ORGANIZATION", 0.8),
    ("GPE", "LOCATION", 0.9),
    ("LOC", "LOCATION", 0.9),
    ("MONEY", "AMOUNT", 0.9),
    ("DATE", "DATE", 0.9),
]
TURKISH_LETTERS = "çğıöşüÇĞIİÖŞÜ"
TURKISH_LETTERS_STRICT = "ğışĞİŞ"
