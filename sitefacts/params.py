"""Fixed values shared by the operators. Every operator takes them as overridable arguments."""

from html.entities import html5

# --- fixed values: results depend on these exact words, weights and patterns -------------------------

# Seeds used when the caller names none.
DEFAULT_SEEDS = ("postman.com", "supabase.com", "vapi.ai")

# Elements that never hold content.
STRIP_TAGS = (
    "script", "style", "svg", "canvas", "noscript", "iframe",
    "header", "footer", "nav", "form", "button", "input",
    "textarea", "select", "option", "picture", "source", "video", "audio",
)

# Substrings of a class or id that mark an element as noise.
NOISE_WORDS = (
    "cookie", "banner", "privacy-popup", "consent", "modal", "advertisement",
    "social-share", "newsletter-signup", "tracking", "promo-bar",
)

# Attributes that survive pruning.
KEPT_ATTRIBUTES = ("href", "title", "alt")

# Elements without content in HTML.
VOID_TAGS = (
    "area", "base", "basefont", "bgsound", "br", "col", "command", "embed", "frame", "hr", "image",
    "img", "input", "isindex", "keygen", "link", "menuitem", "meta", "nextid", "param", "source",
    "spacer", "track", "wbr",
)

# Elements rendered as Markdown lines, with the text before and after each.
LINE_TAGS = ("h1", "h2", "h3", "h4", "p", "li", "a", "tr")

# Elements that end a block of running text.
BLOCK_TAGS = (
    "address", "article", "aside", "blockquote", "body", "dd", "div", "dl", "dt", "fieldset", "figure",
    "h1", "h2", "h3", "h4", "h5", "h6", "head", "hr", "html", "li", "main", "ol", "p", "pre", "section",
    "table", "tbody", "td", "th", "thead", "title", "tr", "ul",
)

# Link keywords and their weights.
LINK_WEIGHTS = {
    "about": 10, "about-us": 10, "team": 12, "leadership": 12, "company": 8, "founders": 12,
    "people": 8, "our-team": 12,
    "contact": 10, "contact-us": 10, "reach-us": 9, "support": 6,
    "pricing": 9, "product": 7, "platform": 7, "features": 6,
}

# Link paths with these endings are files, not pages.
ASSET_EXTENSIONS = (
    ".png", ".jpg", ".jpeg", ".gif", ".svg", ".webp", ".ico",
    ".pdf", ".zip", ".tar", ".gz", ".mp4", ".mp3", ".wav",
    ".css", ".js", ".json", ".xml", ".txt",
)
SKIPPED_HREF_PREFIXES = ("#", "javascript:", "mailto:", "tel:")

# Addresses found in text are dropped for these domains, domain endings and user names.
DENIED_EMAIL_DOMAINS = (
    "example.com", "yourdomain.com", "domain.com", "test.com", "sentry.io", "wixpress.com", "schema.org",
)
DENIED_EMAIL_ENDINGS = (".png", ".jpg", ".jpeg", ".gif", ".webp", ".svg", ".css", ".js")
DENIED_EMAIL_USERS = ("name", "user", "email", "someone", "john.doe")

# Handles after /in/ that are site sections, not people.
RESERVED_HANDLES = ("company", "feed", "posts", "pulse", "jobs")

# Page titles with one of these terms are bot challenges.
CHALLENGE_TERMS = ("just a moment...", "cloudflare", "ddos-guard", "attention required")

# USD per million tokens: model -> (prompt, completion).
MODEL_RATES = {
    "gemini-3.6-flash": ("0.075", "0.30"),
    "gemini-1.5-flash": ("0.075", "0.30"),
    "gemini-1.5-pro": ("1.25", "5.00"),
    "gemini-2.0-flash": ("0.10", "0.40"),
    "gpt-4o-mini": ("0.15", "0.60"),
    "gpt-4o": ("2.50", "10.00"),
    "llama-3.3-70b-versatile": ("0.59", "0.79"),
    "llama-3.1-8b-instant": ("0.05", "0.08"),
}
DEFAULT_RATE = ("0.15", "0.60")

# Texts put into records whose answer could not be used.
OVERVIEW_UNAVAILABLE = "Company overview unavailable."
PARSE_ERROR_OVERVIEW = "Overview extraction failed due to response format error."
PARSE_ERROR_AUDIENCE = "Unknown ICP."
PARSE_ERROR_REASON = "JSON parse error on LLM response."
SALVAGED_OVERVIEW = "Overview unavailable."
SALVAGED_AUDIENCE = "Unknown target audience."

# Layout of one extraction request.
REQUEST_TEMPLATE = """Extract structured company intelligence for domain: '{domain}'

### Detected DOM Heuristics:
- Emails: {emails}
- LinkedIn URLs: {profiles}

### Cleaned Website Content:
{context}

### Expected JSON Format:
{
  "domain": "{domain}",
  "company_name": "Company Name",
  "company_overview": "Two-sentence summary.",
  "target_audience_icp": "Target audience description.",
  "contact_points": ["contact@domain.com"],
  "key_leadership": [
    {
      "name": "Full Name",
      "role": "Role / Title",
      "linkedin_url": "https://www.linkedin.com/in/username or null"
    }
  ],
  "data_confidence_score": 0.85,
  "confidence_reasoning": "Reasoning for score."
}
"""

# Limits.
MAX_SUBPAGES = 3
MARKDOWN_BUDGET = 12000
SITE_PAGE_BUDGET = 8000
MIN_MAIN_TEXT = 150
PARTIAL_MIN_CHARS = 500
PAGE_TIMEOUT_MS = 20000
MAX_SEARCH_HITS = 3
# --- end of fixed values ----------------------------------------------------------------------------

# Named character references (complete ones, with the semicolon), the common ones first; and the characters that the
# numbers 128 to 159 stand for.
_COMMON = ("amp", "lt", "gt", "quot", "apos", "nbsp", "copy", "reg", "mdash", "ndash", "rsquo", "lsquo", "rdquo", "ldquo", "hellip")
_NAMED = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
ENTITIES = {name: _NAMED[name] for name in (*_COMMON, *sorted(_NAMED))}
WINDOWS_1252 = {code: bytes([code]).decode("cp1252", "ignore") or chr(code) for code in range(128, 160)}

# Choices of this engine: what counts as a main-content block.
MIN_BLOCK_CHARS = 25
MAX_LINK_SHARE = 0.5
REPEATED_BLOCK_PAGES = 3

# Rows of one join key that a task joins; keys with more are spread over several.
HOT_KEY_ROWS = 200_000

# --- size of tasks: no result depends on these ----------------------------------------------------------

# Bytes of page text that one task parses, a matter of some 10 to 20 seconds.
TASK_BYTES = 8 << 20
# Sites whose pages one task derives and parses.
TASK_ROWS = 1000
