"""The engine's own vocabulary, as data: sectors, actions, themes and public bodies.

Latin entries are whole words, Chinese ones stand anywhere in a text.  Both can be replaced by the caller's own tables
(``classify.classify``, ``extract.headline_entity``).
"""

from __future__ import annotations

#: (word that ends a firm's Latin name, ending of its Chinese name, industry)
SECTORS = [
    ("airlines", "航空", "航空业"), ("bank", "银行", "银行业"), ("batteries", "电池", "电池"), ("chemicals", "化工", "化学品"), ("energy", "能源", "能源电力"),
    ("foods", "食品", "食品饮料"), ("games", "游戏", "软件服务"), ("insurance", "保险", "保险业"), ("logistics", "物流", "交通运输"), ("mining", "矿业", "矿产"),
    ("motors", "汽车", "汽车"), ("optics", "光学", "光学"), ("paper", "纸业", "造纸"), ("pharma", "制药", "医药"), ("retail", "零售", "零售业"), ("robotics", "机器人", "机器人"),
    ("securities", "证券", "证券业"), ("semiconductor", "半导体", "芯片"), ("shipping", "航运", "交通运输"), ("software", "软件", "软件服务"), ("steel", "钢铁", "钢铁"),
    ("telecom", "通信", "通信网"), ("textiles", "纺织", "纺织"), ("water", "水务", "水务"),
]
#: (word that ends the Latin name of a public body, ending of its Chinese name)
BODIES = [("ministry", "部"), ("authority", "港务局"), ("board", "管理局"), ("bureau", "统计局"), ("office", "货币署"), ("council", "委员会")]
#: action: (event type, Latin words, Chinese parts); the first action that has one in the text is taken.
ACTIONS = {
    "earnings": ("earnings_guidance", "profit margin margins slips loss outlook", "利润 毛利率 营收"),
    "order": ("contract_order", "wins bid bids tender tenders", "中标 招标 签下"),
    "deal": ("deal_mna", "venture stake joins spin", "合资 入股 加入 合作推进"),
    "supply": ("production_supply", "expand restart delays complete output phase", "重启 扩建 推迟 完工 落地"),
    "regulation": ("regulation", "clears fines fined inquiry recall permit", "罚款 核查 召回 许可"),
    "policy": ("policy", "ministry council authority board monetary", "能源部 货币署 管理局 港务局"),
    "financing": ("financing_capital", "loan credit lenders notes", "授信 债券 贷款"),
    "capital_return": ("company_action", "dividend payout", "分红 股份回购"),
    "commodity": ("commodity_disruption", "ore grain resin fuel", "矿石 粮食 树脂"),
    "macro_release": ("macro_data", "statistics census survey", "统计局 调查"),
    "macro_move": ("macro_data", "rates currency wages", "汇率 利率 工资"),
    "signal": ("social_signal", "hearsay lol psa", "听说 据说"),
}
#: theme: (Latin words, Chinese parts); the first in order is taken.
THEMES = {
    "credit": ("lending loan loans bank", "信贷 贷款"),
    "weather": ("rains rain drought warmer", "天气 水位"),
    "trade": ("tariff export customs", "关税 出口"),
    "wages": ("wage wages pension", "工资 养老金"),
    "ports": ("ports port harbour", "港口 港务"),
    "raw materials": ("ore scrap grain", "矿石 废料 粮食"),
}
