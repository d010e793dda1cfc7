"""Patterns, word lists and limits that decide what is kept. All of them are fixed values."""

from __future__ import annotations

CONTEXT_DEPENDENT = (
    r"\b(?:according to (?:chapter|figure|table|the (?:analysis|author|book|document|example|provided (?:context|"
    r"information|text)|text))|(?:figure|table|chapter)\s+\d+(?:\.\d+)*|the author(?:'s|s')?\b|this (?:book|chapter|"
    r"document|example|section|text)\b|(?:shown|used|described|presented) in the (?:example|figure|table)\b|"
    r"the (?:above|below|following|preceding) (?:example|figure|table|text)\b|at the time of writing)"
)
UNANCHORED_CURRENT = (
    r"\b(?:what (?:is|are|was|were) the current\b|current(?:ly)? (?:recommended|supported|available|trading|priced|"
    r"worth)|current (?:share |stock |market )?(?:price|value|level|rate|spread|volume|version|status)|"
    r"latest (?:stable )?(?:version|release|framework)|where can the latest version)"
)
DATE_ANCHOR = (
    r"\b(?:as of|in|on|during|for)\s+(?:(?:19|20)\d{2}|(?:january|february|march|april|may|june|july|august|"
    r"september|october|november|december)\b|android\s+\d)"
)
NONANSWER = (
    r"^(?:n/?a(?:\s|$)|unknown(?:\s|\(|$)|not (?:specified|provided|given|available|mentioned)(?:\s|,|\.|$)|(?:the |"
    r"an? )?(?:answer|cause|date|definition|detail|formula|information|percentage|purpose|rate|reason|value|"
    r"year).{0,80}\b(?:is|are|was|were) not (?:specified|provided|given|available|mentioned)\b|"
    r"cannot be determined\b|the exact formula is not provided\b)"
)
QUESTION_REQUEST = (
    r"\b(?:what (?:question|questions)|give an example of a question|which question|key questions?|"
    r"questions? (?:should|did|does|can))\b"
)
FINANCE = (
    r"\b(?:account(?:ing|s?)|acquisition|alpha|amorti[sz]ation|annuit(?:y|ies)|arbitrage|asset|auction|"
    r"balance sheet|bank(?:ing|s?)?|basis points?|bear market|beta|bid|bond|book value|broker(?:age|s?)?|budget|"
    r"bull market|capital|cash(?: flow)?|candlestick|collateral|commodit(?:y|ies)|commission|corporat(?:e|ion)|"
    r"correlation|covariance|credit|currenc(?:y|ies)|debt|derivative|discount|dividend|dow jones|earnings?|"
    r"econom(?:ic|ics|y|etric)|equity|exchange rate|fasb|financ(?:e|ial|ing)|fiscal|forex|fund|futures?|gdp|"
    r"goodwill|hedg(?:e|ing)|inflation|insur(?:ance|er)|interest|invest(?:ment|ors?|ing)|liquidit(?:y|ies)|loan|"
    r"macroeconomic|margin|market|monetary|mortgage|option|p/[be]\b|portfolio|pric(?:e|ing)|profit|loss|quant|"
    r"recession|return|risk|s&p(?:\s*500)?|securit(?:y|ies)|shareholders?|shares?|slippage|stock(?:broker|holder|"
    r"s)?|swap|tasuki|tax|technical analysis|transaction costs?|trade|traders?|trading|treasury|valuation|variance|"
    r"volatility|wealth|yield|[$€£¥]\s?\d)\b"
)
CYBER = (
    r"\b(?:access|account|active directory|adb|administrator|aircrack|amap|android|array|attack|audit|authenticat|"
    r"authori[sz]|aws|bash|bluetooth|boot ?loader|browser|buffer|certificate|cipher|class|cloud|cluster|code|"
    r"command|computer|container|credential|crypt|cve|database|dataframe|debug|device|dictionary|directory|"
    r"disaster recovery|dns|docker|encrypt|exception|exploit|feature|file|firewall|forensic|function|hash|https?|"
    r"impersonat|incident|injection|ip address|iptables|java|kernel|key ?store|least privilege|linux|log(?:ging)?|"
    r"machine learning|malware|memory|metasploit|method|mimikatz|model|msf(?:cli|console)?|nat|network|nmap|numpy|"
    r"oracle|overflow|packet|pandas|password|permission|policy|process|programming|protocol|python|rdp|registry|"
    r"regression|reverse engineering|root|s3|sandbox|server|shell|siem|sklearn|smtp|software|sql|ssh|system|tcp|"
    r"threat|tls|token|unix|user|variable|vulnerabilit|web|windows|wireless)"
)
CONCEPTUAL_QUESTION = (
    r"^(?:how|why|explain|describe|define|compare|what (?:are|does|do|is|makes|role|purpose|causes|happens|effect|"
    r"impact|relationship|difference|advantages|benefits|risks|formula|factors|steps)|under what|which (?:factors|"
    r"method|model|strategy|conditions))\b"
)
TRIVIA = (
    r"^(?:who|when|where|in what year|what year|what date|what is the title|what was the name|which publication|"
    r"which journal)\b"
)
META = (
    r"\b(?:as an ai|language model|provided (?:context|document|information|text)|the answer is not|"
    r"cannot be determined|not enough information)\b"
)
FORMULA_HEAVY = r"\b(?:calculate|calculation|equation|formula|mathematical expression)\b|[=∑√∫^]|[a-z]\d\s*[()]|<su[bp]>|[ρσμβΔ]"
PRECISE_FACT = (
    r"\b(?:(?:19|20)\d{2}|reported (?:earnings|eps|price|return|value)|approximate (?:price|percentage|rate|return|"
    r"value|yield)|what (?:is|was) the (?:exact |current )?(?:price|percentage|rate|value|yield)|in (?:this|"
    r"the) (?:context|example|stage)|stage \d+)\b"
)
TRUSTED_FINANCE_SOURCE = (
    r"(?:^investments\.md$|Monnaie, banque et marchés financiers|Principes de l'économie|Macroéconomie|"
    r"options-futures-and-other-derivatives|valuation-measuring-and-managing|financial-statement-analysis|"
    r"Security-Analysis|Stochastic Calculus for Finance|Financial Calculus|"
    r"trading-and-exchanges-market-microstructure|Algorithmic and High-Frequency Trading|"
    r"advances-in-active-portfolio-management|machine-learning-for-asset-managers|"
    r"Probability and Statistical Inference)"
)
CASE_SPECIFIC = (
    r"\b(?:according to|in this simulation|in this example|in the example|contribute(?:d|s)? to|reported|"
    r"historically|the author|the paper|this fund|this company|this trader)\b"
)
SOURCE_REFERENCE = (
    r"(?:\b(?:this|the)\s+(?:book|document|text|chapter|module|section|manual|guide|handbook|course|material|"
    r"presentation|lecture)\b|according\s+to\s+(?:the|this)\s+(?:book|document|text|chapter|author|manual|guide)|"
    r"as\s+(?:described|explained|stated|mentioned|discussed|noted|outlined|covered|presented|defined|"
    r"highlighted)\s+in\s+(?:the|this)\s+(?:book|document|text|chapter|manual|guide)|\bthe\s+author\s+says\b|"
    r"\bin\s+(?:chapter|module|section)\s+\d\b|\btarget\s+audience\b)"
)
CYBER_CATEGORIES = {
    "identity_access": (
        r"\b(?:identity|access|account|authentication|authorization|credential|password|privilege|mfa|multi-factor|iam|"
        r"user)\b"
    ),
    "network_security": r"\b(?:network|firewall|dns|tcp|udp|ip address|vpn|wireless|routing|segmentation|proxy|gateway)\b",
    "cloud_security": r"\b(?:aws|amazon web services|azure|cloud|s3|ec2|storage|bucket|cloudtrail|serverless)\b",
    "application_security": r"\b(?:application|web|owasp|injection|api|code|devsecops|software|vulnerability|secure development)\b",
    "incident_forensics": r"\b(?:incident|forensic|evidence|log|monitor|detect|response|malware|threat|event|alert|recovery)\b",
    "governance_risk": (
        r"\b(?:policy|risk|control|audit|compliance|governance|standard|framework|management system|"
        r"business continuity)\b"
    ),
    "cryptography": r"\b(?:encrypt|cryptograph|certificate|pki|cipher|hash|key management|signature|tls|secret)\b",
    "endpoint_hardening": r"\b(?:endpoint|operating system|windows|linux|device|hardening|patch|configuration|server|workstation|mobile)\b",
}
FINANCE_CATEGORIES = {
    "portfolio_risk": (
        r"\b(?:portfolio|diversification|risk|beta|alpha|asset allocation|efficient frontier|sharpe|drawdown|"
        r"value at risk|var\b|covariance)\b"
    ),
    "derivatives": (
        r"\b(?:option|futures?|forward|swap|derivative|black.scholes|binomial|strike|call|put|delta|gamma|vega|theta|"
        r"implied volatility|payoff)\b"
    ),
    "markets_trading": (
        r"\b(?:market|trading|trader|trade|order|liquidity|bid|ask|spread|execution|broker|exchange|technical indicator|"
        r"momentum|trend)\b"
    ),
    "quantitative": (
        r"\b(?:regression|correlation|variance|probability|distribution|time series|monte carlo|stochastic|optimization|"
        r"machine learning|algorithm|model|python|pandas|numpy|forecast|mean reversion)\b"
    ),
    "economics": (
        r"\b(?:economic|economy|inflation|gdp|monetary|fiscal|interest rate|recession|macroeconomic|microeconomic|"
        r"supply|demand|central bank)\b"
    ),
    "corporate_accounting": (
        r"\b(?:accounting|balance sheet|cash flow|earnings|revenue|profit|valuation|company|corporate|dividend|equity|"
        r"shareholder|capital)\b"
    ),
    "banking_credit": r"\b(?:bank|credit|loan|debt|bond|yield|default|collateral|mortgage|counterparty|treasury|fixed income)\b",
    "financial_planning": r"\b(?:investment|investor|wealth|saving|retirement|insurance|tax|budget|annuity|fund|financial planning)\b",
}
SOURCE_FAMILY_LIMITS = {"CIS_AWS_STORAGE": 0, "CIS_OTHER": 1800, "ISO": 1200, "CERTFR": 900, "ANSSI": 500, "NIST": 400, "OWASP": 100}
PRECISE_NUMBER = r"\b(?:19|20)\d{2}\b|[$€£¥]|\b\d+(?:\.\d+)?\s*%"
KNOWN_BAD_INSTRUCTIONS = (
    "how does lightgbm perform with categorical encoding compared to one hot encoding?",
    "how do utf-16 and utf-32 encodings differ from other schemes?",
    "what is the role of the black-schwartz option pricing model?",
)
FINANCE_STEMS = (
    ("DERIVATIVES", r"option|future|derivative|volatility|hedg|stochastic calculus"),
    ("MARKET_MICROSTRUCTURE", r"microstructure|high.frequency|exchange|execution"),
    ("QUANT_ML", r"machine.learning|python|algorithm|reinforcement|statistics|kaggle"),
    ("PORTFOLIO_RISK", r"portfolio|asset manager|risk|allocation"),
    ("ECONOMICS_BANKING", r"economic|macro|monnaie|banque|money|central bank"),
    ("ACCOUNTING_VALUATION", r"accounting|statement|valuation|security.analysis"),
    ("TRADING", r"trading|trader|chart|candlestick|ichimoku|forex"),
    ("INVESTING", r"invest|buffett|graham|stock|market"),
)
OFF_DOMAIN_TITLES = ("learning python 5e", "python for data analysis", "introduction to machine learning with python", "b072ptrzsj ebok")
DOT_LEADER = r"(?:\.\s*){8,}"
URL = r"https?://|www\."
FRONT_MATTER = r"other titles in the|library of congress catalog(?:ing)?|all rights reserved|isbn(?:-1[03])?"
SERIES_FRONT_MATTER = r"other titles in the|library of congress catalog(?:ing)?"
COPYRIGHT_NOISE = r"copyright|reproduction|all rights reserved"
LICENSE_FRONT_MATTER = r"courseware license agreement|important\s*[-–—]?\s*read carefully|complete and exclusive statement of agreement"
INDEX_REFERENCE = r",\s*\d+(?:\s*[-–]\s*\d+)?"
CONTINUE_INSTRUCTION = "Continue fidèlement le passage documentaire ci-dessous. N'ajoute aucune information absente de la source."
DOCUMENT_SUFFIXES = (".pdf", ".epub", ".md", ".rst", ".txt", ".doc", ".pptx")
