"""Scanner rules as plain tables; users extend a rule set by adding rows."""

from __future__ import annotations

from typing import NamedTuple

# Label, pattern, and whether case matters


class Rule(NamedTuple):
    category: str
    label: str
    pattern: str
    ignore_case: bool = True

    @property
    def hints(self) -> tuple[str, ...]:
        """Lower-case words of which a matching line must contain one; empty if unknown."""
        return HINTS.get(self.label, ())


# Words every match of a rule contains. They spare most lines the patterns; rules without an entry
# are matched by pattern alone.
HINTS = {
    "ignore previous instructions": ("previous",),
    "disregard prior": ("disregard",),
    "you are now": ("now",),
    "system prompt override": ("prompt",),
    "override instructions": ("override",),
    "new instructions": ("instruction",),
    "jailbreak attempt": ("anything", "developer"),
    "prompt leak": ("prompt",),
    "role hijack": ("forget",),
    "hidden instruction": ("system", "instruction", "hidden"),
    "role play": ("pretend",),
    "encoding evasion": ("base64",),
    "repeat after me": ("repeat",),
    "bypass safety": ("safety", "bypass"),
    "output control": ("exactly",),
    "markdown image exfiltration": ("](http",),
    "translate evasion": ("translate",),
    "~/.ssh/": ("~/.ssh/",),
    "~/.aws/credentials": ("~/.aws/credentials",),
    "~/.config/gcloud": ("~/.config/gcloud",),
    "~/.kube/config": ("~/.kube/config",),
    "/etc/shadow": ("/etc/shadow",),
    "~/.netrc": ("~/.netrc",),
    "~/.env": ("~/.env",),
    "~/.docker/config.json": ("~/.docker/config.json",),
    "~/.npmrc": ("~/.npmrc",),
    "~/.pypirc": ("~/.pypirc",),
    "API key (AI provider)": ("_api_key",),
    "AWS secret": ("$aws_",),
    "database credential": ("$database_url", "$db_password"),
    "GitHub token": ("$github_token", "$gh_token"),
    "secret/private key": ("$secret_key", "$private_key"),
    "Slack token": ("$slack_token",),
    "Stripe secret": ("$stripe_secret_key",),
    "JWT secret": ("$jwt_secret",),
    "encryption key": ("$encryption_key",),
    "sudo": ("sudo",),
    "chmod 777": ("chmod",),
    "chown root": ("chown",),
    "eval with decode": ("eval",),
    "char code construction": ("fromcharcode",),
    "hex escape sequence": ("\\x",),
    "unicode escape sequence": ("\\u",),
    "zero-width characters": ("\u200b", "\u200c", "\u200d", "\u200e", "\u200f", "\ufeff"),
    "python dynamic exec": ("exec",),
    "char code round-trip": ("charcodeat",),
    "try to": ("try",),
    "if possible": ("possible",),
    "you might want to": ("might",),
    "perhaps consider": ("perhaps",),
    "consider using": ("consider",),
    "if needed": ("needed",),
    "if appropriate": ("appropriate",),
    "as necessary": ("necessary",),
    "if applicable": ("applicable",),
    "when relevant": ("relevant",),
    "TODO": ("todo",),
    "FIXME": ("fixme",),
    "XXX": ("xxx",),
    "TBD": ("tbd",),
    "coming soon": ("coming",),
    "work in progress": ("progress",),
    "not yet implemented": ("yet",),
    "placeholder bracket": ("[insert", "[fill", "[change", "[update", "[replace", "[your"),
    "PLACEHOLDER": ("[placeholder]",),
    "follow best practices": ("practices",),
    "handle errors properly": ("errors",),
    "write clean code": ("readable",),
    "ensure code quality": ("quality",),
    "consider edge cases": ("edge",),
    "use proper formatting": ("formatting",),
    "be thorough": ("thorough",),
    "do not log": ("log",),
    "disable logging": ("logging",),
    "suppress output": ("suppress",),
    "no logging": ("logging",),
    "turn off log": ("log",),
}

PROMPT_INJECTION = [
    ("ignore previous instructions", r"ignore\s+(all\s+)?previous\s+instructions"),
    ("disregard prior", r"disregard\s+(all\s+)?(prior|previous|above)"),
    ("you are now", r"you\s+are\s+now\s+(?:a|an|the)\s+"),
    ("system prompt override", r"system\s*prompt\s*(override|injection|change)"),
    ("override instructions", r"override\s+(all\s+)?(instructions|rules|guidelines)"),
    ("new instructions", r"new\s+instructions?\s*:"),
    ("jailbreak attempt", r"(do\s+anything\s+now|developer\s+mode)"),
    ("prompt leak", r"(reveal|show|print|output)\s+(your|the)\s+(system\s+)?prompt"),
    ("role hijack", r"forget\s+(everything|all|your)\s+(you|instructions|rules)"),
    ("hidden instruction", r"<\s*(?:system|instruction|hidden)\s*>"),
    ("role play", r"pretend\s+(?:to\s+be|you\s+are)\s+(?:a|an|the)\s+"),
    ("encoding evasion", r"(?:in\s+base64|encode\s+(?:as|in|to)\s+base64|base64\s+encod)"),
    ("repeat after me", r"repeat\s+after\s+me"),
    ("bypass safety", r"(?:ignore\s+safety|bypass\s+(?:filter|safety|restriction))"),
    ("output control", r"output\s+the\s+following\s+exactly"),
    (
        "markdown image exfiltration",
        r"!\[.*?\]\(https?://(?!(?:docs\.|github\.|imgur\.|i\.stack|shields\.io|raw\.githubusercontent\.))[^\)]*",
    ),
    (
        "translate evasion",
        r"translate\s+(?:this|the\s+following)\s+(?:to|into)\s+"
        r"(?!(?:english|spanish|french|german|chinese|japanese|korean"
        r"|portuguese|italian|arabic|hindi|russian|dutch|swedish|turkish)\b)",
    ),
]
SENSITIVE_PATH = [
    ("~/.ssh/", r"~/\.ssh/", True),
    ("~/.aws/credentials", r"~/\.aws/credentials", True),
    ("~/.config/gcloud", r"~/\.config/gcloud", True),
    ("~/.kube/config", r"~/\.kube/config", True),
    ("/etc/shadow", r"/etc/shadow", True),
    ("~/.netrc", r"~/\.netrc", True),
    ("~/.env", r"~/\.env\b", False),
    ("~/.docker/config.json", r"~/\.docker/config\.json", True),
    ("~/.npmrc", r"~/\.npmrc\b", False),
    ("~/.pypirc", r"~/\.pypirc\b", False),
]
SENSITIVE_ENV = [
    ("API key (AI provider)", r"\$(?:ANTHROPIC|OPENAI|GEMINI|GOOGLE)_API_KEY"),
    ("AWS secret", r"\$(?:AWS_SECRET_ACCESS_KEY|AWS_SESSION_TOKEN)"),
    ("database credential", r"\$(?:DATABASE_URL|DB_PASSWORD)"),
    ("GitHub token", r"\$(?:GITHUB_TOKEN|GH_TOKEN)"),
    ("secret/private key", r"\$(?:SECRET_KEY|PRIVATE_KEY)"),
    ("Slack token", r"\$SLACK_TOKEN"),
    ("Stripe secret", r"\$STRIPE_SECRET_KEY"),
    ("JWT secret", r"\$JWT_SECRET"),
    ("encryption key", r"\$ENCRYPTION_KEY"),
]
DANGEROUS_COMMAND = [
    ("sudo", r"\bsudo\s+"),
    ("chmod 777", r"\bchmod\s+777\b"),
    ("chown root", r"\bchown\s+root\b"),
]
OBFUSCATION = [
    ("eval with decode", r"eval\s*\(\s*(?:atob|Buffer\.from|base64\.b64decode)\s*\(", True),
    ("char code construction", r"String\.fromCharCode\s*\(", True),
    ("hex escape sequence", r"(?:\\x[0-9a-fA-F]{2}){4,}", False),
    ("unicode escape sequence", r"(?:\\u[0-9a-fA-F]{4}){4,}", False),
    ("zero-width characters", r"[\x{200B}-\x{200F}\x{FEFF}]", False),
    ("tag characters", r"[\x{E0000}-\x{E007F}]", False),
    ("python dynamic exec", r"exec\s*\(\s*(?:compile|__import__)\s*\(", True),
    ("char code round-trip", r"charCodeAt\b.*\bfromCharCode\b", True),
]
SECURITY_RULES = (
    [Rule("prompt_injection", label, p) for label, p in PROMPT_INJECTION]
    + [Rule("sensitive_path", *r) for r in SENSITIVE_PATH]
    + [Rule("sensitive_env", label, p, False) for label, p in SENSITIVE_ENV]
    + [Rule("dangerous_command", label, p, False) for label, p in DANGEROUS_COMMAND]
    + [Rule("obfuscation", *r) for r in OBFUSCATION]
)
EXAMPLE_WORDS = r"(?:for\s+example|e\.g\.|such\s+as|like:)"

HEDGING = [
    ("try to", r"\btry\s+to\s+\w+"),
    ("if possible", r"\bif\s+(?:at\s+all\s+)?possible\b"),
    ("you might want to", r"\byou\s+might\s+(?:want|wish)\s+to\b"),
    ("perhaps consider", r"\bperhaps\s+(?:consider|you)\b"),
    ("consider using", r"\bconsider\s+(?:using|adding|implementing)\b"),
]
VAGUE_CONDITION = [
    ("if needed", r"\bif\s+needed\b"),
    ("if appropriate", r"\bif\s+appropriate\b"),
    ("as necessary", r"\bas\s+necessary\b"),
    ("if applicable", r"\bif\s+applicable\b"),
    ("when relevant", r"\bwhen\s+relevant\b"),
]
IMPRECISE_RULES = [Rule("hedging", *r) for r in HEDGING] + [Rule("vague condition", *r) for r in VAGUE_CONDITION]
UNFINISHED_RULES = [
    Rule("unfinished_content", "TODO", r"\bTODO\s*:"),
    Rule("unfinished_content", "FIXME", r"\bFIXME\s*:"),
    Rule("unfinished_content", "XXX", r"\bXXX\s*:"),
    Rule("unfinished_content", "TBD", r"\bTBD\b", False),
    Rule("unfinished_content", "coming soon", r"\bcoming\s+soon\b"),
    Rule("unfinished_content", "work in progress", r"\bwork\s+in\s+progress\b"),
    Rule("unfinished_content", "not yet implemented", r"\bnot\s+yet\s+(?:implemented|done|complete)\b"),
    Rule(
        "unfinished_content",
        "placeholder bracket",
        r"\[(?:INSERT|FILL\s+IN|CHANGE\s+THIS|UPDATE\s+THIS|REPLACE|YOUR)\s+[^\]]+\]",
    ),
    Rule("unfinished_content", "PLACEHOLDER", r"\[PLACEHOLDER\]"),
]
GENERIC_RULES = [
    Rule("generic_advice", "follow best practices", r"follow\s+(the\s+)?best\s+practices"),
    Rule("generic_advice", "handle errors properly", r"handle\s+errors\s+(?:properly|correctly|gracefully)"),
    Rule("generic_advice", "write clean code", r"write\s+clean[\s,]+readable\s+code"),
    Rule("generic_advice", "ensure code quality", r"ensure\s+(?:code\s+)?quality"),
    Rule("generic_advice", "consider edge cases", r"consider\s+(all\s+)?edge\s+cases"),
    Rule("generic_advice", "use proper formatting", r"use\s+proper\s+formatting"),
    Rule("generic_advice", "be thorough", r"be\s+thorough\s+(?:in|and|with)"),
]
LOGGING_RULES = [
    Rule("logging_suppression", "do not log", r"\bdo\s+not\s+log\b"),
    Rule("logging_suppression", "disable logging", r"\bdisable\s+logging\b"),
    Rule("logging_suppression", "suppress output", r"\bsuppress\s+output\b"),
    Rule("logging_suppression", "no logging", r"\bno\s+logging\b"),
    Rule("logging_suppression", "turn off log", r"\bturn\s+off\s+log"),
]
SECURITY_WORDS = (
    r"\b(passwords?|credentials?|secrets?|pii|tokens?|sensitive|personal|api[_-]?keys?|auth|bearer|private)\b"
)
EXCLUDED_DIRS = (".git", "node_modules", "vendor", "__pycache__", ".venv")
