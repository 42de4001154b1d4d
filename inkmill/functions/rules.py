"""Fixed values of the document-to-QA rules: word lists, patterns and limits, as columns refer to them."""

# Titles, figures and list items; the first kind that matches counts.
TITLE_PATTERNS = (
    r"^[\d\.]+\s+[一-龥a-zA-Z\s]{3,30}$",
    r"^[一二三四五六七八九十]+[、.\s][一-龥a-zA-Z\s]{3,30}$",
    r"^第[一二三四五六七八九十]+[章节]\s*[一-龥a-zA-Z\s]{3,30}$",
    r"^[一-龥a-zA-Z\s]{2,20}[:：]$",
)
FIGURE_WORDS = ("图", "表", "Figure", "Table")
FIGURE_PATTERNS = tuple(rf"({word}\s*\d+[\.:：][一-龥a-zA-Z\s]+)" for word in FIGURE_WORDS)
LIST_PATTERNS = (r"^\d+[\.)]\s+", r"^[a-zA-Z][\.)]\s+", r"^[•\-*]\s+", r"^[\(（]\d+[\)）]\s+")

# Web addresses and site names.
_TLD = "com|org|net|cn|io|ai"
_NAME = r"[a-zA-Z0-9\.-]+"
_SITES = "onerail|greyorange|vimaan|softeon|rebus|thescxchange|loginextsolutions|optioryx|go|blog|jascicloud|businesswire|dcvelocity"
URL_ROUNDS = (
    rf"\s+https?://{_NAME}\.[a-zA-Z]{{2,}}[^\s]*",
    rf"\s+www\.{_NAME}\.[a-zA-Z]{{2,}}[^\s]*",
    rf"\s+{_NAME}\.(?:{_TLD})[^\s]*",
    r"\s+\([^)]*?(?:https?://|www\.)[^)]*?\)",
    r"\s+（[^）]*?(?:https?://|www\.)[^）]*?）",
    rf"\s+\([^)]*?{_NAME}\.(?:{_TLD})[^)]*?\)",
    rf"\s+（[^）]*?{_NAME}\.(?:{_TLD})[^）]*?）",
    rf"[^\s\.](?:{_SITES})\.(?:com|io|ai|org)(?:[\s\.,?!;:]|$)",
    rf"[^\s\.]{_NAME}\.[a-zA-Z]{{2,}}[\s\.,?!;:]",
    rf"[^\s\.]{_NAME}\.[a-zA-Z]{{2,}}$",
    rf"(?<=[^\.])\b(?:{_SITES})\b",
    rf"\s+\.\s*(?:{_TLD})",
    rf"\s+(?:{_TLD})\s*\.",
    r"(?<=\s)[a-z]{2,}\.(?=[,.\s])",
    r"(?<=\s)(?:onerail|greyorange|vimaan|softeon|rebus|thescxchange|loginext|optioryx|go|blog|jasci|businesswire|dcvelocity)",
    r"onerail(?=[,.\s]|$)",
    r"\s+[a-zA-Z0-9]{3,}(?=。)",
    r"\s+\([^)]{0,10}\)",
    r"\s+（[^）]{0,10}）",
    r"(?<=\s)(?:onerail|greyorange|vimaan|softeon|rebus|thescxchange|loginextsolutions|optioryx|go)(?=[\s.,?!;:])",
    r"(?=[a-z])(?<=。)[a-z]{2,}(?=。)",
    r"(?<=\s)[a-z]{2,}(?=[,.])",
)
# Of each round, texts without which its pattern cannot match: one of each group must be there.
_DOTTED, _SITE = tuple(f".{x}" for x in _TLD.split("|")), tuple(_SITES.split("|"))
URL_SIGNS = (
    ((".",), ("http",)), (("www.",),), (_DOTTED,), (("://", "www."), ("(",)), (("://", "www."), ("（",)), (_DOTTED, ("(",)), (_DOTTED, ("（",)), (_DOTTED, _SITE), ((".",),), ((".",),), (_SITE,),
    ((".",), tuple(_TLD.split("|"))), ((".",), tuple(_TLD.split("|"))), ((".",),), ((*_SITE, "loginext", "jasci"),), (("onerail",),), (("。",),), (("(",),), (("（",),), (_SITE,), (("。",),), ((",", "."),),
)
SITE_NAMES = ("onerail", "greyorange", "vimaan", "softeon", "rebus", "thescxchange", "loginext", "optioryx")

# Texts.
CONTROL = r"[\x00-\x1F\x7F-\x9F]"
PAGE_MARK = r"===\s*第\s*\d+\s*页\s*==="
SYSTEM_PROMPT = "你是一个专业的供应链技术领域顾问，擅长解释各种供应链执行技术的概念、应用场景和发展趋势。请基于你的专业知识回答问题。"
APOLOGY = "对不起，我没有足够的信息来回答这个问题。"
DEFINITION_WORDS = ("是指", "指的是", "被定义为", "定义为", "technology")

# Terminology: standard term and its variants, in order.
TERMINOLOGY = (
    ("WMS", ("仓库管理系统", "仓储管理系统", "Warehouse Management System")),
    ("TMS", ("运输管理系统", "Transportation Management System")),
    ("WES", ("仓库执行系统", "Warehouse Execution System")),
    ("WCS", ("仓库控制系统", "Warehouse Control System")),
    ("ERP", ("企业资源规划", "Enterprise Resource Planning")),
    ("MES", ("制造执行系统", "Manufacturing Execution System")),
    ("SCM", ("供应链管理", "Supply Chain Management")),
    ("RTTVP", ("实时运输可视化平台", "Real-time Transportation Visibility Platform")),
    ("AI", ("人工智能", "Artificial Intelligence", "AI技术", "人工智能技术")),
    ("IoT", ("物联网", "Internet of Things", "IoT技术", "物联网技术")),
    ("ML", ("机器学习", "Machine Learning")),
    ("RFID", ("射频识别", "Radio Frequency Identification")),
    ("GAN", ("生成对抗网络", "Generative Adversarial Network")),
    ("数字孪生", ("Digital Twin", "digital twin技术")),
    ("区块链", ("Blockchain", "blockchain技术")),
    ("大数据", ("Big Data",)),
    ("自动驾驶", ("Autonomous Driving", "无人驾驶")),
    ("机器人编排", ("Robot Orchestration", "RaaS")),
    ("供应链融合", ("Supply Chain Convergence", "供应链整合")),
    ("最后一公里配送", ("Last Mile Delivery",)),
    ("库存优化", ("Inventory Optimization",)),
)

# Topics.
KNOWN_TERMS = (
    "生成式AI", "仿人工作机器人", "自动驾驶卡车", "最后一公里配送", "室内资产实时定位", "自主数据采集", "仓库资源规划", "仓库劳动力预测",
    "仓储数字孪生", "仓库执行系统", "多代理机器人编排", "仓库仿真建模", "实时运输可视化", "供应链协同网络", "供应链融合", "物联网", "区块链",
    "WMS", "供应链执行技术", "供应链可视化", "RTTVP", "WES", "自动化技术",
)
TOPIC_DEFINITIONS = (
    r"([\w\s]{4,25})(技术定义与原理|是一种|技术是指)",
    r"([\w\s]{4,25})[:：](技术定义|原理|是指|指的是|包括|涵盖)",
    r"([\w\s]{4,25})是[供物仓运输链智能].*?领域.*?的.*?技术",
)
TOPIC_DEFINITION_SIGNS = ("技术定义与原理|是一种|技术是指", "[:：](技术定义|原理|是指|指的是|包括|涵盖)", "是[供物仓运输链智能].*领域.*的.*技术")
TOPIC_DEFINITION_WORDS = (("技术定义与原理", "是一种", "技术是指"), ("技术定义", "原理", "是指", "指的是", "包括", "涵盖"), ("领域",))
TOPIC_NOUNS = ("系统", "平台", "技术", "方案", "解决方案", "服务", "工具", "框架")
TOPIC_BAD_PARTS = ("》", "《", "「", "」", "..", "…", "。。")
TOPIC_STOPS = ("技术定义", "当前成熟度", "应用场景", "实施与落地", "未来发展", "领先企业", "安全与责任", "责任归属", "限制", "挑战", "问题", "的因素", "前处于", "案正位于")
TOPIC_GENERIC = ("技术", "系统", "平台", "方案")

# Questions: difficulty, templates; dimension, difficulties.
TEMPLATES = {
    "basic": ("什么是{topic}？", "{topic}的基本定义是什么？", "请简要解释{topic}的概念。", "{topic}代表了什么技术？", "{topic}包含哪些核心要素？"),
    "medium": ("{topic}的工作原理是什么？", "{topic}如何实现其功能？", "为什么{topic}在供应链中很重要？", "{topic}解决了什么问题？", "{topic}的核心机制是如何运作的？"),
    "advanced": ("{topic}在哪些场景下最适合应用？", "什么情况下企业应该考虑实施{topic}？", "{topic}在什么行业应用最广泛？为什么？", "什么时候是引入{topic}的最佳时机？", "{topic}能为哪类企业带来最大价值？"),
    "expert": ("{topic}有哪些局限性？", "企业在考虑{topic}时需要评估哪些因素？", "哪些公司最适合采用{topic}？为什么？", "为什么有些企业可能不适合实施{topic}？", "{topic}相比其他解决方案有什么优缺点？"),
    "challenge": ("实施{topic}时企业通常会面临哪些挑战？", "{topic}在当前市场中存在哪些限制？", "为什么{topic}在某些场景下难以落地？", "企业如何克服{topic}实施过程中的阻碍？", "{topic}的成本效益分析关键点有哪些？"),
}
DIMENSIONS = {"释义类": ("basic", "medium"), "应用类": ("advanced",), "对比类": ("expert",), "推导类": ("expert", "challenge"), "纠错类": ("challenge",)}

# Answers.
ANSWER_DEFINITIONS = ("是指", "定义", "概念", "原理", "技术", "系统", "指的是")
ANSWER_KEYS = ("应用场景", "挑战", "优势", "趋势", "特点", "价值", "案例")

# Repair.
CUT_QUESTIONS = (r"^线》", r'^技术[》")]', r'^供应链[》")]', r'^系统[》")]', r'^平台[》")]', r'^管理[》")]', r'^什么是[》")]')
QUESTION_EMPTY, QUESTION_UNKNOWN = "请解释供应链执行技术的概念和应用？", "什么是供应链执行技术？"
QUESTION_COMPANIES, QUESTION_SHORT = "哪些公司最适合采用供应链执行技术？为什么？", "请解释供应链执行技术的重要性？"
ANSWER_SHORT = "供应链执行技术是指支持和优化供应链日常运作的各种技术解决方案，包括仓库管理系统、运输管理系统、物联网技术等。这些技术能够提高供应链的可视性、效率和灵活性，帮助企业更好地应对市场变化和客户需求。"
ANSWER_TAIL = "各种供应链管理和执行工具。"

# Quality.
BAD_PARTS = ("》", "《", "\u0001", "===")
TOPIC_BLACKLIST = ("null", "undefined", "none")
QUESTION_STOPS = ("的", "是", "在", "与", "和", "有", "什么", "如何", "为什么", "哪些", "多少", "为何")
CAUSE_WORDS = ("因为", "原因", "由于")
