"""Word lists, patterns and limits that results depend on."""

# --- fixed values: relevance gate -----------------------------------------------------------
GATE_KEYWORDS = (
    "cve", "malware", "exploit", "ransomware", "backdoor", "apt", "payload", "command", "persistence", "ttps",
    "threat", "advisory", "campaign", "malicious", "attack", "analysis", "cybercrime", "phish", "stealer", "loader",
    "dropper", "dfir", "sysmon", "powershell", "registry", "process injection",
)
HASH_PATTERN = r"\b[a-f0-9]{32,64}\b"
IPV4_PATTERN = r"\b(?:\d{1,3}\.){3}\d{1,3}\b"
URL_PATTERN = r"\bhttps?://[^\s)>\]]+\b"
DOMAIN_PATTERN = r"\b(?:[a-z0-9-]+\.)+[a-z]{2,}\b"
CVE_PATTERN = r"cve-\d{4}-\d{4,7}"
TECHNIQUE_PATTERN = r"\bt1[0-9]{3}\b"
TEAM_PAGE_PATTERN = r"/author/|/team/|/experts/|/page/\d+"
GATE_MIN_SCORE = 2

# --- fixed values: links --------------------------------------------------------------------
BAD_PATHS = (
    "/faq", "/platform", "/industry", "/category", "/tag", "/features", "/services", "/page", "/newsletter",
    r"\?paged=\d+", r"\?_paged=\d+", "/about", "/rsac/", "/weekly", "/monthly", "/quarterly",
)
RESEARCH_PATHS = (
    "/blog/", "/research/", "/posts/", "/post/", "/insights/", "/threat-research/", "/intelligence/", "/labs/",
    "/articles/", "/news/", "/security-blog/", "/threat-intelligence/", "/tech_blog/",
)
POSITIVE_TERMS = (
    "threat", "research", "reverse", "malware", "ransom", "cve", "apt", "ttx", "ioc", "iocs", "ttp", "ttps", "exploit",
    "loader", "stealer", "backdoor", "campaign", "dfir", "ir", "forensic", "shellcode", "c2", "command-and-control",
    "botnet", "phishing", "initial-access", "persistence", "lateral", "exfiltration", "tactics", "techniques",
    "procedure", "tactic", "technique", "intrusion", "detect", "detection", "hunt", "hunting", "analysis", "analyzing",
    "reverse-engineering", "vulnerability", "0day", "zero-day", "rce", "lpe", "privesc", "advisory",
)
NEGATIVE_TERMS = (
    "press-release", "press", "webinar", "podcast", "release-notes", "roadmap", "pricing", "case-study", "testimonial",
    "announcing", "announcement", "newsletter", "weekly-recap", "monthly-recap", "quarterly", "hiring", "career",
    "careers", "culture", "company-news", "investor", "funding", "raise", "raised", "series-a", "series-b", "series-c",
)
JUNK_SLUGS = ("index", "home", "feed", "rss", "archive")
MAX_ARTICLES_PER_SOURCE = 12
RECENT_DAYS = 7
FEED_PATHS = ("/feed/", "/rss/", "/feed", "/rss", "/atom.xml", "/rss.xml", "/feed.xml", "/blog/feed/", "/blog/rss/")

# --- fixed values: chunks and prompts -------------------------------------------------------
CHUNK_SIZE, CHUNK_OVERLAP = 18_000, 1_500
MAX_INPUT_TOKENS = 8_000
REQUEST_DELAY, MODEL_DELAY = 2.0, 4.5

# --- fixed values: record schema ------------------------------------------------------------
TTP_FIELDS = (
    "processes", "command_lines", "powershell", "scripts", "registry_keys", "image_loads", "network_connections",
    "file_activity", "persistence", "process_relations",
)
IOC_FIELDS = ("hashes", "ip_addresses", "domains", "urls")
TOP_LISTS = ("malware_families", "cves", "authors")
TOP_SCALARS = ("title", "description", "attribution")
#: Names a field has had; the first that is there counts.
OLD_NAMES = {
    "ttps": ("TTPs",), "iocs": ("IOCs",), "cves": ("CVEs",), "command_lines": ("commandline", "command_line"),
    "image_loads": ("image_load",), "scripts": ("scripting_engine",),
}
#: More names found in older records.
MORE_NAMES = {
    "ip_addresses": ("ips", "IPs", "IP Addresses"), "urls": ("URLs",), "hashes": ("Hashes", "SHA256", "MD5", "file_hashes"),
    "domains": ("Domains",), "processes": ("processs",), "file_activity": ("file_modifications",),
    "authors": ("author", "Authors"), "description": ("summary",),
}
TITLE_FRAGMENT_STARTS = (
    "the ", "a ", "an ", "this ", "that ", "these ", "those ", "and ", "but ", "or ", "so ", "because ", "since ",
    "although ", "while ", "whereas ", "however ", "therefore ", "is ", "was ", "are ", "were ", "has ", "have ", "had ",
    "will ", "would ", "should ", "could ", "may ", "might ", "it ", "they ", "we ", "i ",
)

# --- fixed values: placeholders -------------------------------------------------------------
PLACEHOLDER_STARTS = (
    "<.*>$", r"-\s*CVE-YYYY", "CVE-YYYY", "null$", "N/?A$", "unknown$", "placeholder", r"example\s", "MD5/SHA1/SHA256$",
    "IPv4/IPv6$", r"placeholder\.invalid", "EXAMPLE_AUTHOR_PLACEHOLDER", "Jane Smith$", "John Doe$", "Jane Doe$",
    "Author Name$", r"<author[\s_]*name>$", r"evil\[\.\]example\[\.\]com", "Acme Threat Labs",
)
CONTAMINATION = (
    "EXAMPLEONLY", "placeholder.invalid", "EXAMPLE_AUTHOR_PLACEHOLDER", "evil[.]example[.]com", "evil.example.com",
    "Acme Threat Labs", "powershell.exe -NoP -W Hidden -Enc SQBFAFgA", r"C:\Users\Public\update.exe",
    r"HKCU\Software\Microsoft\Windows\CurrentVersion\Run\Updater",
    r"Registry Run key (HKCU) pointing to C:\Users\Public\update.exe",
    "1234567890abcdef1234567890abcdef", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "ffffffffffffffffffffffffffffffff",
    "0000000000000000000000000000000",
)

# --- fixed values: images and recognised text -----------------------------------------------
DECODABLE_TYPES = ("image/png", "image/jpeg", "image/jpg", "image/gif", "image/webp", "image/bmp", "image/avif")
TECHNICAL_PATTERNS = (
    r"[A-Z]:\\", "/(?:usr|var|etc|opt|home|tmp)/", "HKEY_|HKLM|HKCU", r"\b[a-f0-9]{32,}\b", r"\b\d+\.\d+\.\d+\.\d+\b",
    "https?://", r"\.(?:exe|dll|ps1|bat|vbs|js|py)\b", r"CVE-\d{4}", r"[a-zA-Z0-9_-]+\.(?:com|net|org|io|ru|cn)\b",
)

# --- fixed values: repair of responses ------------------------------------------------------
QUOTED_SCALARS = ("title", "description", "attribution")
FLOW_STARTS = "{[>|&*!%@`"
CODE_MARKS = ("::", "[[", "]]", "{[", "]}", "$_", "$env:", "@(")
ANCHOR_KEYS = ("title", "description", "attribution", "malware_families", "cves", "ttps", "iocs", "authors")
TAIL_LINES = 30

# --- fixed values: page parts ---------------------------------------------------------------
CHROME_TAGS = ("nav", "header", "footer", "aside")
CHROME_NAMES = (
    "related|recommended|sidebar|footer|header|nav|menu|share|social|cookie|newsletter|subscribe|popup|modal|banner|"
    "breadcrumb|pagination|comment|author-bio|tags?|categories|widget|promo|advert|sponsor"
)
IMAGE_SOURCES = ("src", "data-src", "data-lazy-src", "data-original")
ROOT_CLASS = r"(?:article|post|blog|entry|story)[-_](?:body|content|main|wrapper|container)"
ROOT_CLASS_WHOLE = r"(?:content|main-content|post-content)"

# --- fixed values: fetching -----------------------------------------------------------------
CHALLENGE_MARKS = ("cf-browser-verification", "Just a moment", "px-captcha", "PerimeterX", "distil_r_captcha")
TRANSIENT_ERRORS = (
    "timed out", "timeout", "connection reset", "connection aborted", "connection refused", "broken pipe",
    "remote disconnected", "eof occurred", "incomplete read",
)
PAGE_TIMEOUT, IMAGE_TIMEOUT, PROBE_TIMEOUT, MODEL_TIMEOUT = 20, 10, 5, 120
RETRY_PAUSE = 3.0
READ_BUDGET = 60.0
TEMPERATURE, MAX_OUTPUT_TOKENS = 0.2, 6_500
