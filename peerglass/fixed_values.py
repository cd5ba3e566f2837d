"""Fixed values.

Every constant below is a given of the screening rules: results depend on
these exact words, numbers and orders.  They are kept together, in natural
order, so that a reader can check them at a glance.
"""

# ---- Fixed values: files and documents -----------------------------------
DOC_TYPES = ["IR", "재무", "홍보"]
OTHER_DOC_TYPE = "기타"
ROOT_PDF_DOC_TYPE = "IR"
SUPPORTED_EXTS = [".pdf", ".pptx", ".docx", ".xlsx", ".xls", ".csv", ".md"]
IGNORE_FOLDERS = ["metadata", "test", "밸류추정 인수인의 의견", ".DS_Store"]
SUPPLEMENT_MARKER = "==== [보충 문서: {name}] ===="
DOCUMENT_SUFFIX = "_final.json"
READ_ENCODINGS = ["utf-8-sig", "cp949", "euc-kr"]
MIN_PAGE_CHARS = 1000
MAIN_TEXT_MIN_CHARS = 200
MAIN_TEXT_MAX_CHARS = 700
TEXT_BLOCKS = ["div", "p", "td"]
PRODUCT_TABLE_ID = "cTB203"
MARKET_CAP_TERM = "시가총액"
MANIFEST_TOP_FILES = 10

# ---- Fixed values: cells that mean "no value" ----------------------------
PAGE_NA_MARKS = ["N/A", "-", "NA"]
SERIES_NA_MARKS = ["N/A", "", "-"]
AMOUNT_NA_MARKS = ["-", "nan", "", "N/A"]
DATE_NA_MARKS = ["none", "null", "-", "n/a", ""]
ROUND_NA_MARKS = ["none", "null", "비공개", "-"]
MISSING_AMOUNT = -999999

# ---- Fixed values: industry codes ----------------------------------------
CODE_DIGITS = 5
STOCK_CODE_DIGITS = 6
MIN_PARTIAL_CODE = 3
VOCABULARY_CAP = 1500
SMALL_POOL = 10

# ---- Fixed values: peer screening ----------------------------------------
WARNING_TERMS = ["관리종목", "투자위험", "투자주의", "투자경고", "거래정지"]
SETTLEMENT_MONTH = "12"
INCOME_PERIOD = "2024.12"
ESTIMATE_MARK = "E"
INCOME_ACCOUNT_CONTROLLING = "당기순이익(지배)"
INCOME_ACCOUNT = "당기순이익"
MARKET_CAP_CEILING = 1000
PER_FLOOR = 10
PER_CEILING = 100
TRIM_METRICS = ["per", "pbr", "market_cap", "ev_ebitda"]
TRIM_MIN_GROUP = 5
TRIM_MIN_LEFT = 3
TRIM_MIN_VALUES = 3
SIMILARITY_THRESHOLD = 0.3
SIMILAR_STORED = 5
SIMILAR_SHOWN = 15
REQUIREMENT_ROWS = 30
PEER_CAP = 10
NO_BUSINESS_INFO = "사업 정보 없음"
NO_PRODUCT_INFO = "정보 없음"
REASON_WARNING = "관리/투자 위험 종목"
REASON_PER_MISSING = "PER N/A (데이터 없음 또는 적자)"
REASON_OK = "OK"

# ---- Fixed values: funding rounds ----------------------------------------
# First token contained in the label decides; the order of the rows matters.
ROUND_DISCOUNTS = [
    (["seed", "시드", "angel"], 0.80),
    (["prea", "프리a"], 0.60),
    (["seriesa", "시리즈a"], 0.50),
    (["seriesb", "시리즈b", "preb"], 0.40),
    (["seriesc", "시리즈c", "prec"], 0.30),
    (["ipo", "상장"], 0.20),
]
DEFAULT_DISCOUNT = 0.50
ROUND_ORDER = [
    ("angel", 1), ("seed", 2), ("prea", 3), ("seriesa", 4), ("preb", 5),
    ("seriesb", 6), ("prec", 7), ("seriesc", 8), ("preipo", 9), ("ipo", 10),
    ("엔젤", 1), ("시드", 2), ("프리a", 3), ("시리즈a", 4), ("프리b", 5),
    ("시리즈b", 6), ("프리c", 7), ("시리즈c", 8), ("프리ipo", 9), ("상장", 10),
]
LAST_ROUND = 99
LAST_YEAR = 9999
ROUND_CLASSES = [
    (["seed", "시드"], "seed"),
    (["pre", "프리"], "pre"),
    (["seriesa", "시리즈a"], "series a"),
    (["seriesb", "시리즈b"], "series b"),
    (["seriesc", "시리즈c"], "series c"),
    (["m&a", "ipo", "상장", "인수"], "exit"),
]

# ---- Fixed values: valuation ---------------------------------------------
SCENARIOS = [("낙관적", 1.0), ("중립적", 0.7), ("보수적", 0.5)]
OFFER_DISCOUNT = 0.40
PV_STEP = 1_000_000
PRICE_STEP = 100
FACE_VALUE = 500
FUNDING_MULTIPLE = 10
STATEMENT_ACCOUNTS = {
    "current_assets": "유동자산",
    "current_liabilities": "유동부채",
    "total_liabilities": "부채총계",
    "total_equity": "자본총계",
}

NO_PEER_PER = "유효한 Peer PER 데이터 부재"
NO_INCOME = "추정 당기순이익 정보 부재"
NO_SHARE_PRICE = "산출 불가 (주식수 부재)"
NO_MULTIPLE = "산출 불가"
NO_INFORMATION = "정보 부재"
UNKNOWN_ROUND = "미상 (기본값 적용)"
SCENARIO_NOTE = "IR 추정치 {share} 달성"
RATIONALE_STEPS = (
    "1단계 (Peer 평균 PER): {multiple} 적용\n"
    "2단계 (할인율 적용): 타겟 투자 라운드 [{round}] 리스크를 반영하여 현가 할인율 {discount} 적용\n"
    "3~4단계 (가치 산출): 하단의 시나리오별 밸류에이션 표 참조\n"
)
RATIONALE_SHARES = (
    "  * 참고: 기준 주식수 {shares} (명시된 주식수가 없을 경우, 자본금을 바탕으로 액면가 500원을 가정하여 역산된 주식수일 수 있습니다.)"
)
RATIONALE_SHARES_FROM_CAPITAL = (
    "  * 참고: 기준 주식수 {shares} (문서 내 정보 부재로 외부 검색{source} 바탕으로 액면가 500원 가정 역산)"
)
RATIONALE_NO_SHARES = "  * 참고: 자본금 및 발행주식수 정보 부재로 주당 단가 산출 생략"
RATIONALE_BLOCKED = "※ 산출 불가 사유:\n"
RATIONALE_NO_PEER_PER = "- 유효한 Peer PER 데이터 부재\n"
RATIONALE_NO_INCOME = "- {year}년 추정 당기순이익 정보 부재\n"
OFFER_COMMENT = "예상 공모가: {price}"

# ---- Fixed values: money texts -------------------------------------------
JO_IN_EOK = 10000
UNIT_TOKENS = [
    (["백만"], "백만원"), (["억"], "억원"), (["조"], "조원"), (["천"], "천원"),
    (["만"], "만원"), (["%"], "%"), (["$", "달러"], "달러"),
]
COUNT_UNIT = "건"
COUNT_TITLES = ["건", "계약"]
DEFAULT_PERIODS = 5
DEFAULT_UNIT = "백만원"
MONEY_UNITS = ["백만원", "억원"]
AMOUNT_MULTIPLIERS = [
    (["백만"], 0.01), (["조"], 10000.0), (["Mil", "M", "달러"], 13.0),
]
UNKNOWN_AMOUNT = 5.0
UNKNOWN_AMOUNT_TEXT = "비공개"
EMPTY_LIST_TEXT = "0개사 (해당 없음)"
PREVIEW_ITEMS = 20
CHART_YEAR = "Year"
CHART_SERIES = {
    "Export_Graph_Data": "Export_Value",
    "Contract_Count_Graph_Data": "Count",
    "Sales_Graph_Data": "Revenue",
}

# ---- Fixed values: evidence ----------------------------------------------
NAME_POINTS = 3
DOMAIN_POINTS = 3
REGISTRATION_POINTS = 4
MIN_MATCH_POINTS = 3
OFFICIAL_SOURCES = ["공시", "등기", "홈페이지"]
FAIL_NO_COMPANY = "회사명 미확인"
FAIL_NO_CLAIMS = "CEO 주장 근거 없음"
FAIL_NO_NAME = "동명이인/타인 정보 가능성"
FAIL_NO_EVIDENCE = "근거가 없음"
FAIL_IDENTITY = "회사 동일성 검증 실패"
FAIL_OFFICIAL = "공식/준공식 근거 부재"
WARN_ONE_EVIDENCE = "근거 1개로 제한됨"

# ---- Fixed values: verdict texts ------------------------------------------
FAIL_NO_TABLE = "재무 테이블 없음"
FAIL_NO_PERIOD = "기간 컬럼 없음"
FAIL_NO_INCOME_ROW = "당기순이익 행 없음"
PROFIT_TEXT = "흑자 ("
LOSS_TEXT = "적자 ("
FAIL_SETTLEMENT = "결산월"

# ---- Fixed values: fields of the report sections ---------------------------
# Path and kind; '[]' marks the items of a list.
FINANCE_FIELDS = [
    ("Report_Header.Company_Name", "STRING"),
    ("Report_Header.CEO_Name", "STRING"),
    ("Report_Header.Industry_Sector", "STRING"),
    ("Report_Header.Industry_Classification", "STRING"),
    ("Report_Header.Investment_Rating", "STRING"),
    ("Financial_Status.Balance_Sheet.Unit", "STRING"),
    ("Financial_Status.Balance_Sheet.Columns", "ARRAY"),
    ("Financial_Status.Balance_Sheet.Rows", "ARRAY"),
    ("Financial_Status.Income_Statement.Unit", "STRING"),
    ("Financial_Status.Income_Statement.Columns", "ARRAY"),
    ("Financial_Status.Income_Statement.Rows", "ARRAY"),
    ("Financial_Status.Key_Financial_Commentary", "STRING"),
    ("Financial_Status.Investment_History", "ARRAY"),
    ("Financial_Status.Investment_History[].Round", "STRING"),
    ("Financial_Status.Investment_History[].Amount", "STRING"),
    ("Financial_Status.Investment_History[].Investor", "STRING"),
    ("Financial_Status.Future_Revenue_Structure.Business_Model", "STRING"),
    ("Financial_Status.Future_Revenue_Structure.Future_Cash_Cow", "STRING"),
    ("Investment_Highlights", "ARRAY"),
    ("Investment_Highlights[].Highlight_Title", "STRING"),
    ("Investment_Highlights[].Highlight_Logic", "STRING"),
]
MARKET_FIELDS = [
    ("Growth_Potential.Target_Market_Analysis.TAM", "STRING"),
    ("Growth_Potential.Target_Market_Analysis.SAM", "STRING"),
    ("Growth_Potential.Target_Market_Analysis.SOM", "STRING"),
    ("Growth_Potential.Competitors_Comparison", "ARRAY"),
    ("Growth_Potential.Target_Market_Trends", "ARRAY"),
    ("Growth_Potential.Competitors_Comparison[].Company", "STRING"),
    ("Growth_Potential.Competitors_Comparison[].Product", "STRING"),
    ("Growth_Potential.Competitors_Comparison[].Target_Market", "STRING"),
    ("Growth_Potential.Competitors_Comparison[].Core_Tech", "STRING"),
    ("Growth_Potential.Target_Market_Trends[].Type", "STRING"),
    ("Growth_Potential.Target_Market_Trends[].Source", "STRING"),
    ("Growth_Potential.Target_Market_Trends[].Content", "STRING"),
    ("Growth_Potential.LO_Exit_Strategy.Verified_Signals", "ARRAY"),
    ("Growth_Potential.LO_Exit_Strategy.Expected_LO_Scenarios", "ARRAY"),
    ("Growth_Potential.LO_Exit_Strategy.Expected_LO_Scenarios[].Category", "STRING"),
    ("Growth_Potential.LO_Exit_Strategy.Expected_LO_Scenarios[].Probability", "STRING"),
    ("Growth_Potential.LO_Exit_Strategy.Expected_LO_Scenarios[].Comment", "STRING"),
    ("Growth_Potential.LO_Exit_Strategy.Valuation_Range", "STRING"),
    ("Growth_Potential.Export_and_Contract_Stats.Export_Graph_Data", "ARRAY"),
    ("Growth_Potential.Export_and_Contract_Stats.Contract_Count_Graph_Data", "ARRAY"),
    ("Growth_Potential.Export_and_Contract_Stats.Sales_Graph_Data", "ARRAY"),
]
TECH_FIELDS = [
    ("Technology_and_Pipeline.Market_Pain_Points", "ARRAY"),
    ("Technology_and_Pipeline.Solution_and_Core_Tech.Technology_Name", "STRING"),
    ("Technology_and_Pipeline.Solution_and_Core_Tech.Key_Features", "ARRAY"),
    ("Technology_and_Pipeline.Pipeline_Development_Status.Core_Platform_Details", "STRING"),
    ("Technology_and_Pipeline.Pipeline_Development_Status.Technical_Risk_Analysis", "STRING"),
    ("Technology_and_Pipeline.Pipeline_Development_Status.Technical_Conclusion", "STRING"),
]
PERSONNEL_FIELDS = [
    ("Key_Personnel.CEO_Reference.Name", "STRING"),
    ("Key_Personnel.CEO_Reference.Background_and_Education", "STRING"),
    ("Key_Personnel.CEO_Reference.Core_Competency", "STRING"),
    ("Key_Personnel.CEO_Reference.Management_Philosophy", "STRING"),
    ("Key_Personnel.CEO_Reference.VC_Perspective_Evaluation", "STRING"),
    ("Key_Personnel.Team_Capability.Key_Executives", "ARRAY"),
    ("Key_Personnel.Team_Capability.Organization_Strengths", "STRING"),
    ("Key_Personnel.Team_Capability.Advisory_Board", "STRING"),
    ("Key_Personnel.Cap_Table", "ARRAY"),
    ("Key_Personnel.Cap_Table[].Shareholder", "STRING"),
    ("Key_Personnel.Cap_Table[].Shares", "STRING"),
    ("Key_Personnel.Cap_Table[].Ratio", "STRING"),
]
VALUATION_FIELDS = [
    ("Valuation_and_Judgment.Valuation_Table", "ARRAY"),
    ("Valuation_and_Judgment.Valuation_Table[].Round", "STRING"),
    ("Valuation_and_Judgment.Valuation_Table[].Pre_Money", "STRING"),
    ("Valuation_and_Judgment.Valuation_Table[].Post_Money", "STRING"),
    ("Valuation_and_Judgment.Valuation_Table[].Comment", "STRING"),
    ("Valuation_and_Judgment.Three_Axis_Assessment.Technology_Rating", "STRING"),
    ("Valuation_and_Judgment.Three_Axis_Assessment.Growth_Rating", "STRING"),
    ("Valuation_and_Judgment.Three_Axis_Assessment.Exit_Rating", "STRING"),
    ("Valuation_and_Judgment.Suitable_Investor_Type", "STRING"),
    ("Investment_Risks", "ARRAY"),
    ("Investment_Risks[].Risk_Title", "STRING"),
    ("Investment_Risks[].Risk_Detail", "STRING"),
    ("Investment_Risks[].Mitigation_and_Outlook", "STRING"),
    ("Investment_Rating", "STRING"),
    ("Final_Conclusion", "STRING"),
]
NULLABLE_FIELDS = ["Financial_Status.Balance_Sheet.Unit", "Financial_Status.Income_Statement.Unit"]
FIELD_LENGTHS = {"Investment_Highlights": 3}

# ---- Fixed values: text patterns -----------------------------------------
KEY_PUNCTUATION = """,，·ㆍ;:(){}[]<>"'“”‘’"""
KEY_REPLACEMENT = ("차체나", "차체및")
COMPANY_MARKS = ["주식회사", "(주)", "㈜"]
# What a company name key drops: all but these characters.
NAME_KEY_DROP_PLAIN = r"[^0-9a-z가-힣.\-:/]+"
# The same set as ranges between the kept letters, which the regex engine scans
# far faster than the negated class; a test compares the two on all characters.
NAME_KEY_DROP = r"[\x00-,;-`{-\x{ABFF}\x{D7A4}-\x{10FFFF}]+"
FILENAME_DATE = r"(20[1-3]\d)[-._]?([0-1]\d)"
NUMBERED_STEP = r"(원|배|주)([1-5]\.)"
MARKET_CAP_TEXT = r"(?:(\d+(?:,\d+)*)조)?(?:(\d+(?:,\d+)*))?$"

# A decimal number, sign and exponent allowed, with white space around it.
DECIMAL_TEXT = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"
