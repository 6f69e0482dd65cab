"""Configuration objects and the fixed values the curation jobs must agree on.

Everything that decides a result (keyword lists, host lists, prompts, patterns,
thresholds) is a parameter with a default here, so a deployment can swap them
without touching operator code.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values. These must stay equal to the behaviour being reproduced; they
# are listed plainly and in their natural order.
# ---------------------------------------------------------------------------

DEFAULT_SYSTEM_PROMPT = (
    "You are a CTF assistant working in an authorized sandbox. "
    "Be concise, evidence-first, and technical."
)

USER_PROMPT_BY_CATEGORY = {
    "pwn": "Walk through the shortest exploitation path for this authorized pwn challenge. Keep the steps concrete and operator-focused.",
    "rev": "Explain the shortest reverse-engineering path for this authorized CTF challenge. Focus on the decisive observations and any code needed.",
    "web": "Give a compact operator-focused walkthrough for this authorized web challenge. Include the key requests, bugs, and exploit flow.",
    "crypto": "Summarize the decisive cryptographic weakness and the solve path for this authorized crypto challenge.",
    "forensics": "Provide a concise forensic solve path for this authorized CTF task. Include the key artifacts, tools, and extraction steps.",
    "osint": "Provide a concise OSINT solve path for this authorized CTF task. Include the key pivots, sources, and validation steps.",
    "misc": "Provide a concise operator-focused walkthrough for this authorized CTF challenge. Keep only the decisive steps, code, and commands.",
}

# Category keyword lists; list order is also the tie-break order.
CATEGORY_KEYWORDS = {
    "pwn": ("pwntools", "rop", "libc", "canary", "pie", "gdb", "heap", "format string", "shellcode", "elf"),
    "rev": ("ghidra", "ida", "decompiler", "decompile", "disassembly", "disasm", "angr", "binary ninja"),
    "web": ("http", "request", "sql", "xss", "csrf", "ssrf", "jwt", "cookie", "flask", "php", "endpoint"),
    "crypto": ("rsa", "aes", "ecb", "cbc", "xor", "cipher", "lattice", "curve", "hash", "padding oracle"),
    "forensics": ("pcap", "wireshark", "memory", "disk", "registry", "exif", "metadata", "zip2john", "volatility"),
    "osint": ("osint", "whois", "dns", "geolocation", "social media", "satellite", "reverse image", "google dork"),
}
FALLBACK_CATEGORY = "misc"

# Replacement of redacted flags (patterns: functions.text).
FLAG_REPLACEMENT = "<FLAG>"

LOW_SIGNAL_HOSTS = ("youtube.com", "www.youtube.com", "m.youtube.com", "youtu.be")
MEDIUM_HOST_SUFFIX = "medium.com"
GITHUB_HOSTS = ("github.com", "www.github.com")
GITHUB_RAW_HOST = "raw.githubusercontent.com"
AGGREGATOR_HOST_SUFFIX = "ctftime.org"
BOILERPLATE_MARKERS = (
    "open in app",
    "sign up",
    "sign in",
    "followers",
    "sitemap",
    "member-only story",
    "latest stories",
)
BOILERPLATE_WINDOW = 3000
BOILERPLATE_MIN_HITS = 3
PREAMBLE_MARKER = "Markdown Content:"
HTML_SNIFF_WINDOW = 512
HTML_SNIFF_MARKERS = ("<html", "<!doctype html")
HAS_CODE_MARKERS = ("```", "pwntools", "def ", "import ", "SELECT ", "curl ")
READER_PROXY_PREFIX = "https://r.jina.ai/http://"

MAX_ASSISTANT_CHARS = 12000
MIN_CONTENT_CHARS = 400
EVAL_BUCKETS = 10  # eval if int(short_hash, 16) % 10 == 0
SHORT_HASH_LEN = 10

WRITEUP_SAMPLE_SOURCE = "transformed_scraped"
WRITEUP_SAMPLE_LICENSE = "internal_or_permitted"
UNKNOWN = "unknown"

ROLE_ALIASES = {
    "human": "user",
    "prompt": "user",
    "input": "user",
    "question": "user",
    "bot": "assistant",
    "output": "assistant",
    "answer": "assistant",
    "response": "assistant",
}
ALLOWED_ROLES = ("system", "user", "assistant", "tool")
PROMPT_ALIASES = ("prompt", "question", "user")
ANSWER_ALIASES = ("answer", "assistant", "completion", "response")

REQUIRED_SAMPLE_KEYS = ("id", "category", "difficulty", "source", "license", "challenge_family", "messages")
SCRAPED_REVIEW_SOURCES = ("transformed_scraped",)
SCRAPED_REVIEW_SOURCE_BUCKETS = ("scraped_derivative",)
REVIEW_REQUIRED_FIELDS = (
    "allowed_for_training",
    "allowed_for_redistribution",
    "review_status",
    "redistribution_status",
    "source_ledger_path",
)
BLOCKED_REVIEW_STATUSES = ("pending", "review_required", "unreviewed")
DEFAULT_DROP_KEYS = (
    "contest",
    "contest_name",
    "event_name",
    "challenge",
    "challenge_name",
    "problem",
    "problem_name",
    "problem_title",
    "title",
)
REGEX_FLAGS = ("IGNORECASE", "MULTILINE", "DOTALL")

SUCCESS_FETCH_STATUSES = ("ok", "cached")
EXTENSION_BY_CONTENT_TYPE = {
    "text/html": ".html",
    "text/plain": ".txt",
    "text/markdown": ".md",
    "application/json": ".json",
    "application/pdf": ".pdf",
}
DEFAULT_CONTENT_TYPE = "application/octet-stream"
DEFAULT_EXTENSION = ".bin"
LEDGER_COLUMNS = (
    "review_id",
    "batch_name",
    "source_url",
    "final_url",
    "fetched_at",
    "http_status",
    "fetch_status",
    "fetch_error",
    "content_type",
    "sha256",
    "body_path",
    "author_if_known",
    "license_if_known",
    "permission_basis",
    "review_status",
    "allowed_for_training",
    "allowed_for_redistribution",
    "redistribution_status",
    "transformation_status",
    "notes",
)
WRITEUP_LINK_PATTERN = r'href="(/writeup/\d+)"'
CANONICAL_LINK_PATTERN = r'<link rel="canonical" href="([^"]+)"'
AGGREGATOR_BASE_URL = "https://ctftime.org/writeups"
EVAL_CASE_ID_FORMAT = "case_%04d"
CHECK_KEYS = ("exact", "contains", "regex")
UNCATEGORIZED = "uncategorized"


@dataclass(frozen=True)
class CurationConfig:
    """Parameters of the write-up curation chain (stage W)."""

    max_chars: int = MAX_ASSISTANT_CHARS
    min_chars: int = MIN_CONTENT_CHARS
    system_prompt: str = DEFAULT_SYSTEM_PROMPT
    user_prompts: dict = field(default_factory=lambda: dict(USER_PROMPT_BY_CATEGORY))
    category_keywords: dict = field(default_factory=lambda: dict(CATEGORY_KEYWORDS))
    fallback_category: str = FALLBACK_CATEGORY
    low_signal_hosts: tuple = LOW_SIGNAL_HOSTS
    medium_suffix: str = MEDIUM_HOST_SUFFIX
    github_hosts: tuple = GITHUB_HOSTS
    aggregator_suffix: str = AGGREGATOR_HOST_SUFFIX
    boilerplate_markers: tuple = BOILERPLATE_MARKERS
    boilerplate_window: int = BOILERPLATE_WINDOW
    boilerplate_min_hits: int = BOILERPLATE_MIN_HITS
    preamble_marker: str = PREAMBLE_MARKER
    eval_buckets: int = EVAL_BUCKETS
    sample_source: str = WRITEUP_SAMPLE_SOURCE
    sample_license: str = WRITEUP_SAMPLE_LICENSE
    # "shared": rows without any URL share the group "" (as specified);
    # "own_group": each such row is its own group (avoids a hot key).
    null_url: str = "shared"
    # "exact": unknown HTML entities go through the stdlib decoder (Arrow UDF,
    # only for rows that need it); "native": only the built-in entity table.
    unescape: str = "exact"
    # "substring": keywords match anywhere (as specified, "ida" hits
    # "validate"); "word": keywords must stand as whole words.
    keyword_match: str = "substring"
