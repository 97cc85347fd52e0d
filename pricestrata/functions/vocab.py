"""Results depend on these exact words, codes and factors."""

# Enum domains (fixed values).
QUALITY = ("ACCEPTED", "REVIEW_REQUIRED", "REJECTED")
ITEM_TYPES = ("MODEL", "COMMODITY", "GENERIC_GOOD")
RECORD_ORIGINS = ("MANUAL", "RULE", "IMPORT", "AUTO")
ITEM_STATUSES = ("ACTIVE", "INACTIVE", "REVIEW_REQUIRED", "SUPERSEDED")
CONDITIONS = ("NEW", "USED", "REFURBISHED", "UNKNOWN")
MEASURES = ("WEIGHT", "VOLUME", "COUNT", "LENGTH", "AREA", "SET", "OTHER")
SOURCE_TYPES = ("OFFICIAL_MALL", "MAJOR_ECOMMERCE", "SUPERMARKET", "PERSONAL_SITE", "PUBLIC_DATA")
BUSINESS_MODES = ("SELF_OPERATED", "MARKETPLACE", "HYBRID", "WHOLESALE")
ACCESS_MODES = ("API", "HTTP", "BROWSER", "FILE", "MIXED")
REGION_MODES = ("NATIONAL", "REGIONAL", "MIXED")
SELLER_TYPES = (
    "PLATFORM_SELF", "BRAND_OFFICIAL", "THIRD_PARTY", "INDIVIDUAL", "PUBLIC_MARKET", "UNKNOWN",
)
VERIFICATIONS = ("VERIFIED", "UNVERIFIED", "UNKNOWN")
REGION_SCOPES = ("NATIONAL", "PROVINCE", "CITY", "DISTRICT", "DELIVERY_ZONE", "UNKNOWN", "MULTI")
MATCH_STATUSES = ("CANDIDATE", "ACCEPTED", "REJECTED", "REVIEW_REQUIRED", "SUPERSEDED")
MATCH_METHODS = ("GTIN", "MODEL", "RULE", "MANUAL", "ML")
PRICE_NATURES = (
    "RETAIL_OFFER", "WHOLESALE_OFFER", "RETAIL_AVERAGE", "WHOLESALE_AVERAGE", "MARKET_AVERAGE",
    "UNKNOWN",
)
OFFER_NATURES = ("RETAIL_OFFER", "WHOLESALE_OFFER")
AVERAGE_NATURES = ("RETAIL_AVERAGE", "WHOLESALE_AVERAGE", "MARKET_AVERAGE")
PRICE_TYPES = (
    "DIRECT_UNCONDITIONAL", "PUBLISHED_VALUE", "AVAILABILITY_ONLY", "MEMBER", "COUPON", "SUBSIDY",
    "STARTING", "INSTALLMENT", "DEPOSIT", "BUNDLE", "UNKNOWN",
)
PRICING_BASES = ("PACKAGE_TOTAL", "UNIT_QUOTED", "VARIABLE_ESTIMATE", "UNKNOWN")
EXACT_BASES = ("PACKAGE_TOTAL", "UNIT_QUOTED")
FEE_STATUSES = ("ITEM_ONLY", "SEPARATE_FEES_EXCLUDED", "NOT_APPLICABLE", "INSEPARABLE", "UNKNOWN")
ITEM_FEES = ("ITEM_ONLY", "SEPARATE_FEES_EXCLUDED")
TRIGGERS = ("SCHEDULED", "MANUAL", "QUERY_RECRAWL")
ENTITY_TYPES = ("CATEGORY", "PRODUCT", "SEARCH", "LISTING", "SKU", "OFFER", "PUBLIC_PRICE")
FETCH_METHODS = ("API", "HTTP", "BROWSER", "FILE", "REPLAY")
LIFECYCLES = ("ACTIVE", "INACTIVE", "UNKNOWN")
AVAILABILITIES = (
    "ON_SALE", "OUT_OF_STOCK", "RESERVATION", "PRE_SALE", "COMING_SOON", "OFF_SHELF", "UNKNOWN",
)
NON_SELLING = ("OFF_SHELF", "OUT_OF_STOCK", "COMING_SOON")
ORIGINAL_TYPES = ("CROSSED_OUT", "MSRP", "EXPLICIT_ORIGINAL", "NONE")
RUN_TYPES = ("DISCOVERY", "PRICE", "FULL", "REPLAY")
RUN_STATUSES = ("RUNNING", "SUCCEEDED", "PARTIAL", "FAILED", "CANCELLED")
OPERATION_STATUSES = ("PENDING", "SUCCEEDED", "SKIPPED", "FAILED")

# Words that make a displayed price conditional (fixed values).
CONDITIONAL_TERMS = (
    "国补", "补贴", "券后", "领券", "优惠券", "会员", "以旧换新", "换购", "月供", "分期", "低至",
    "起售价", "元起", " 起", "到手价", "最高优惠", "预估", "定金",
)

# Quantity units (fixed values): token -> (measure, canonical unit, base unit, factor).
UNITS = {
    "G": ("WEIGHT", "G", "KG", "0.001"),
    "克": ("WEIGHT", "G", "KG", "0.001"),
    "KG": ("WEIGHT", "KG", "KG", "1"),
    "千克": ("WEIGHT", "KG", "KG", "1"),
    "公斤": ("WEIGHT", "KG", "KG", "1"),
    "JIN": ("WEIGHT", "JIN", "KG", "0.5"),
    "斤": ("WEIGHT", "JIN", "KG", "0.5"),
    "ML": ("VOLUME", "ML", "L", "0.001"),
    "毫升": ("VOLUME", "ML", "L", "0.001"),
    "L": ("VOLUME", "L", "L", "1"),
    "升": ("VOLUME", "L", "L", "1"),
    "PIECE": ("COUNT", "PIECE", "PIECE", "1"),
    "PCS": ("COUNT", "PIECE", "PIECE", "1"),
    "PC": ("COUNT", "PIECE", "PIECE", "1"),
    "个": ("COUNT", "PIECE", "PIECE", "1"),
    "枚": ("COUNT", "PIECE", "PIECE", "1"),
    "只": ("COUNT", "PIECE", "PIECE", "1"),
}

# Identity aliases (fixed values): field -> source word -> code.
ALIASES = {
    "grade": {
        "特级": "PREMIUM", "一级": "GRADE_1", "一等": "GRADE_1", "1级": "GRADE_1",
        "二级": "GRADE_2", "二等": "GRADE_2", "2级": "GRADE_2", "A级": "GRADE_A", "A": "GRADE_A",
        "AA级": "GRADE_AA", "AA": "GRADE_AA",
    },
    "freshness_state": {
        "鲜": "FRESH", "新鲜": "FRESH", "冷鲜": "CHILLED", "冷藏": "CHILLED", "冰鲜": "CHILLED",
        "冷冻": "FROZEN", "冻": "FROZEN", "常温": "AMBIENT",
    },
    "packaging": {
        "箱装": "BOX", "盒装": "BOX", "袋装": "BAG", "板装": "TRAY", "托盘装": "TRAY",
        "真空包装": "VACUUM", "简装": "SIMPLE",
    },
    "variety": {"红富士": "RED_FUJI", "红富士苹果": "RED_FUJI", "REDFUJI": "RED_FUJI"},
    "egg_type": {
        "鸡蛋": "CHICKEN_EGG", "鲜鸡蛋": "CHICKEN_EGG", "普通鸡蛋": "CHICKEN_EGG",
        "土鸡蛋": "FREE_RANGE_CHICKEN_EGG",
    },
    "cut": {
        "五花肉": "PORK_BELLY", "猪五花肉": "PORK_BELLY", "带皮五花肉": "PORK_BELLY",
        "里脊": "PORK_TENDERLOIN", "猪里脊": "PORK_TENDERLOIN", "梅花肉": "PORK_COLLAR",
        "猪梅花肉": "PORK_COLLAR",
    },
    "bone_state": {"去骨": "BONELESS", "无骨": "BONELESS", "带骨": "BONE_IN"},
    "skin_state": {"带皮": "SKIN_ON", "去皮": "SKINLESS", "无皮": "SKINLESS"},
    "commodity_group": {
        "蔬菜": "VEGETABLE", "水果": "FRUIT", "肉禽蛋": "MEAT_EGG", "肉类": "MEAT_EGG",
        "禽蛋": "MEAT_EGG",
    },
}

# Quoted units of public price tables (fixed values).
QUOTED_UNITS = {
    "元/500克": "CNY_PER_500G", "元/500g": "CNY_PER_500G", "元/公斤": "CNY_PER_KG",
    "元/千克": "CNY_PER_KG", "元/kg": "CNY_PER_KG",
}
QUOTED_BASE = {"CNY_PER_500G": "0.5", "CNY_PER_KG": "1"}

# Province names of the wholesale table (fixed values); the corps has no province code.
REGION_CODES = {
    "北京市": "110000", "天津市": "120000", "河北省": "130000", "山西省": "140000",
    "内蒙古自治区": "150000", "辽宁省": "210000", "吉林省": "220000", "黑龙江省": "230000",
    "上海市": "310000", "江苏省": "320000", "浙江省": "330000", "安徽省": "340000",
    "福建省": "350000", "江西省": "360000", "山东省": "370000", "河南省": "410000",
    "湖北省": "420000", "湖南省": "430000", "广东省": "440000", "广西壮族自治区": "450000",
    "海南省": "460000", "重庆市": "500000", "四川省": "510000", "贵州省": "520000",
    "云南省": "530000", "西藏自治区": "540000", "陕西省": "610000", "甘肃省": "620000",
    "青海省": "630000", "宁夏回族自治区": "640000", "新疆维吾尔自治区": "650000",
    "新疆生产建设兵团": "XJ_CORPS",
}

# Wholesale commodities (fixed values): code, source id, name, group.
WHOLESALE_COMMODITIES = (
    ("NAPA_CABBAGE", "170060", "大白菜", "蔬菜"),
    ("CUCUMBER", "170130", "黄瓜", "蔬菜"),
    ("CARROT", "170260", "胡萝卜", "蔬菜"),
    ("WHITE_RADISH", "170070", "白萝卜", "蔬菜"),
    ("TOMATO", "170120", "西红柿", "蔬菜"),
    ("POTATO", "170080", "土豆", "蔬菜"),
    ("ONION", "170090", "洋葱", "蔬菜"),
    ("GARLIC", "170100", "蒜头", "蔬菜"),
    ("GINGER", "170110", "生姜", "蔬菜"),
    ("EGGPLANT", "170140", "茄子", "蔬菜"),
    ("BROCCOLI", "170340", "西兰花", "蔬菜"),
    ("CHICKEN_EGG", "150010", "鲜鸡蛋", "禽蛋"),
    ("PORK_HIND", "130014", "后臀尖", "肉类"),
    ("BEEF_LEG", "130025", "牛腿肉", "肉类"),
    ("DRESSED_CHICKEN", "280020", "白条鸡", "肉禽蛋"),
)

# City retail sheet whitelist (fixed values): code, group, name, specification, unit.
CITY_COMMODITIES = (
    ("QINGCAI", "蔬菜", "青菜", "新鲜一级", "元/500克"),
    ("JIMAOCAI", "蔬菜", "鸡毛菜", "新鲜一级", "元/500克"),
    ("NAPA_CABBAGE", "蔬菜", "大白菜", "新鲜一级", "元/500克"),
    ("CUCUMBER", "蔬菜", "黄瓜", "新鲜一级", "元/500克"),
    ("CARROT", "蔬菜", "胡萝卜", "新鲜一级", "元/500克"),
    ("RED_FUJI_APPLE", "水果", "苹果", "红富士一级", "元/500克"),
    ("CHICKEN_EGG", "肉禽蛋", "鸡蛋", "新鲜完整", "元/500克"),
    ("LEAN_PORK", "肉禽蛋", "鲜猪肉", "精瘦肉", "元/500克"),
)
SHEET_LABELS = ("类别", "品种", "规格", "单位", "均价")
MARKET_HEADERS = ("地区", "市场", "当日价格", "前一日价格", "环比", "走势图")

# Availability wording per brand (fixed values): first hit wins, in this order.
AVAILABILITY_TERMS = {
    "HUAWEI": (
        ("OFF_SHELF", ("已下架", "商品下架")),
        ("COMING_SOON", ("即将开售", "即将上市")),
        ("OUT_OF_STOCK", ("暂时缺货", "无货", "到货通知")),
        ("RESERVATION", ("预约",)),
        ("PRE_SALE", ("预售",)),
        ("ON_SALE", ("立即购买", "加入购物车", "现货")),
    ),
    "XIAOMI": (
        ("OFF_SHELF", ("已下架", "商品下架")),
        ("COMING_SOON", ("即将开售", "即将上市")),
        ("OUT_OF_STOCK", ("缺货", "无货", "暂时没有")),
        ("RESERVATION", ("预约",)),
        ("PRE_SALE", ("预售",)),
        ("ON_SALE", ("有现货", "现货")),
    ),
    "OPPO": (
        ("OFF_SHELF", ("已下架",)),
        ("OUT_OF_STOCK", ("暂时缺货", "已售罄", "到货通知")),
        ("RESERVATION", ("预约",)),
        ("PRE_SALE", ("预售",)),
        ("ON_SALE", ("立即购买", "加入购物车", "现货")),
    ),
    "VIVO": (
        ("OFF_SHELF", ("商品已下架",)),
        ("OUT_OF_STOCK", ("暂时缺货", "已售罄", "到货通知")),
        ("RESERVATION", ("预约",)),
        ("PRE_SALE", ("预售",)),
        ("ON_SALE", ("立即购买", "加入购物车", "现货")),
    ),
    "APPLE": (("OUT_OF_STOCK", ("暂无供应", "暂时缺货", "缺货")),),
}
AVAILABILITY_DEFAULT = {"APPLE": "ON_SALE"}

# Product-name rules per brand (fixed values): excluded words, then category patterns in order.
# Patterns run on the upper-cased normalised name and are anchored at its start.
NAME_RULES = {
    "HUAWEI": {
        "exclude": (
            "HONOR", "荣耀", "WIKO", "HI NOVA", "华为智选", "表带", "底座", "保护壳", "保护套",
            "保护膜", "键盘", "触控笔", "手写笔", "充电器", "充电线", "数据线", "扩展坞", "鼠标",
            "耳机",
        ),
        "categories": (
            ("TABLET", "HUAWEI MATEPAD|华为平板"),
            ("LAPTOP", "HUAWEI MATEBOOK"),
            ("DESKTOP", "HUAWEI MATESTATION|HUAWEI 擎云台式"),
            ("WATCH", "HUAWEI WATCH|华为手表"),
            ("PHONE", "HUAWEI MATE|HUAWEI PURA|HUAWEI NOVA|华为畅享"),
        ),
    },
    "XIAOMI": {
        "exclude_start": ("REDMI",),
        "exclude": ("红米", "手环", "耳机", "配件", "保护壳", "键盘", "触控笔"),
        "categories": (
            ("TABLET", "XIAOMI PAD|小米平板"),
            ("LAPTOP", "XIAOMI BOOK|小米笔记本"),
            ("WATCH", "XIAOMI WATCH|小米手表"),
            ("PHONE", r"XIAOMI\s+(?:[0-9]|MIX|CIVI)|小米\s*[0-9]"),
        ),
    },
    "OPPO": {
        "exclude_start": ("ONEPLUS",),
        "exclude": ("一加", "权益包", "CARE+", "保障", "耳机", "保护壳", "充电器"),
        "categories": (
            ("TABLET", "OPPO PAD"),
            ("WATCH", "OPPO WATCH"),
            ("PHONE", r"OPPO\s+(?:FIND|RENO|A|K)"),
        ),
    },
    "VIVO": {
        "exclude_start": ("IQOO", "NEX"),
        "exclude": (
            "耳机", "手环", "充电", "数据线", "保护壳", "保护膜", "贴膜", "碎屏宝", "键盘",
            "触控笔", "表带", "底座",
        ),
        "categories": (
            ("TABLET", r"VIVO\s+PAD"),
            ("WATCH", r"VIVO\s+WATCH"),
            ("PHONE", r"VIVO\s+(?:X|S|Y|V)"),
        ),
    },
}
# Exclusions that must match the name as written, not its upper-cased form (fixed values).
CASED_EXCLUSIONS = {"OPPO": ("CARE+",)}

DEVICE_CATEGORIES = ("PHONE", "TABLET", "LAPTOP", "DESKTOP", "WATCH")
SPEC_FIELDS = (
    "color", "capacity", "memory", "connectivity", "size", "edition", "manufacturer_part_number",
)
# Quote fields that may never identify a device (fixed values).
MUTABLE_KEYS = (
    "price", "current_price", "original_price", "availability", "stock", "title", "name",
    "observed_at", "fetched_at", "url",
)

# Source dimension -> specification field per brand (fixed values), first present key wins.
DIMENSION_FIELDS = {
    "APPLE": {
        "capacity": ("capacity", "storage"),
        "memory": ("memory",),
        "color": ("color",),
        "connectivity": ("connectivity", "network"),
        "size": ("size", "screensize", "casesize"),
        "edition": ("edition",),
    },
    "HUAWEI": {"color": ("颜色",)},
    "OPPO": {
        "color": ("color", "颜色"),
        "edition": ("version", "版本"),
        "connectivity": ("网络", "connectivity"),
        "size": ("尺寸", "size"),
    },
    "VIVO": {
        "color": ("color", "颜色"),
        "edition": ("version", "版本"),
        "connectivity": ("网络", "connectivity"),
        "size": ("尺寸", "size"),
    },
    "XIAOMI": {"color": ("color",)},
}
# Dimensions that still stay in the attribute map after being used as a field (fixed values).
DIMENSIONS_KEPT = {"HUAWEI": ("颜色",)}
# Only these advertised dimensions vary inside one product (fixed values).
VARIANT_LABELS = ("颜色", "版本", "规格", "尺寸", "网络", "款式")

# Seed dimensions (fixed values).
BRANDS = (
    ("APPLE", "Apple", "Apple"), ("HUAWEI", "华为", "Huawei"), ("XIAOMI", "小米", "Xiaomi"),
    ("OPPO", "OPPO", "OPPO"), ("VIVO", "vivo", "vivo"),
)
# code, name, source type, business mode, access mode, region mode, domains, brand
CHANNELS = (
    ("APPLE_CN_WEB", "Apple 中国大陆在线商店", "OFFICIAL_MALL", "SELF_OPERATED", "HTTP",
     "NATIONAL", ("www.apple.com.cn",), "APPLE"),
    ("HUAWEI_CN_WEB", "华为商城", "OFFICIAL_MALL", "SELF_OPERATED", "MIXED", "NATIONAL",
     ("www.vmall.com", "m.vmall.com", "item.vmall.com", "openapi.vmall.com"), "HUAWEI"),
    ("XIAOMI_CN_WEB", "小米商城", "OFFICIAL_MALL", "SELF_OPERATED", "MIXED", "NATIONAL",
     ("www.mi.com",), "XIAOMI"),
    ("OPPO_CN_WEB", "OPPO 商城", "OFFICIAL_MALL", "SELF_OPERATED", "API", "NATIONAL",
     ("www.opposhop.cn",), "OPPO"),
    ("VIVO_CN_WEB", "vivo 官方商城", "OFFICIAL_MALL", "SELF_OPERATED", "API", "NATIONAL",
     ("shop.vivo.com.cn",), "VIVO"),
    ("SHANGHAI_FRESH_RETAIL", "上海市主要主副食品平均零售价", "PUBLIC_DATA", "SELF_OPERATED",
     "HTTP", "REGIONAL", ("fgw.sh.gov.cn",), None),
    ("MOFCOM_FRESH_WHOLESALE", "商务部百家日报农副产品批发价格", "PUBLIC_DATA", "WHOLESALE",
     "HTTP", "MIXED", ("cif.mofcom.gov.cn",), None),
)
# code, parent, name, level, path, leaf, profile, measure
CATEGORIES = (
    ("FOOD", None, "食品", 0, "/FOOD/", False, "category-root", None),
    ("FRESH_FOOD", "FOOD", "生鲜食品", 1, "/FOOD/FRESH/", False, "category-root", None),
    ("FRESH_FRUIT", "FRESH_FOOD", "新鲜水果", 2, "/FOOD/FRESH/FRUIT/", False, "category-root",
     "WEIGHT"),
    ("FRESH_APPLE", "FRESH_FRUIT", "鲜苹果", 3, "/FOOD/FRESH/FRUIT/APPLE/", True, "fresh-apple",
     "WEIGHT"),
    ("FRESH_EGG", "FRESH_FOOD", "鲜蛋", 2, "/FOOD/FRESH/EGG/", True, "packaged-egg", "COUNT"),
    ("FRESH_MEAT", "FRESH_FOOD", "鲜肉", 2, "/FOOD/FRESH/MEAT/", False, "category-root",
     "WEIGHT"),
    ("FRESH_PORK", "FRESH_MEAT", "鲜猪肉", 3, "/FOOD/FRESH/MEAT/PORK/", True, "fresh-pork",
     "WEIGHT"),
    ("FRESH_MONITORED_COMMODITY", "FRESH_FOOD", "政府监测生鲜品种", 2,
     "/FOOD/FRESH/MONITORED_COMMODITY/", True, "government-fresh", "WEIGHT"),
    ("ELECTRONICS", None, "电子设备", 0, "/ELECTRONICS/", False, "category-root", None),
    ("COMPUTER", "ELECTRONICS", "电脑", 1, "/ELECTRONICS/COMPUTER/", False, "category-root", None),
    ("PHONE", "ELECTRONICS", "手机", 1, "/ELECTRONICS/PHONE/", True, "electronic-device", "COUNT"),
    ("TABLET", "ELECTRONICS", "平板", 1, "/ELECTRONICS/TABLET/", True, "electronic-device",
     "COUNT"),
    ("LAPTOP", "COMPUTER", "笔记本电脑", 2, "/ELECTRONICS/COMPUTER/LAPTOP/", True,
     "electronic-device", "COUNT"),
    ("DESKTOP", "COMPUTER", "台式电脑", 2, "/ELECTRONICS/COMPUTER/DESKTOP/", True,
     "electronic-device", "COUNT"),
    ("WATCH", "ELECTRONICS", "手表", 1, "/ELECTRONICS/WATCH/", True, "electronic-device", "COUNT"),
)
