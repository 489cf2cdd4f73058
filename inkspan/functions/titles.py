"""Title, metadata and document-type rules: ordered patterns as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkspan.functions.text import contains_chinese, strip

# Patterns by slot. A later slot wins over an earlier one, but for the first two.
_H = "一-鿿"
SLOTS = (
    r"^(第|上|下)((\d+)|(\\math(rm|bf)?\s?(I{0,3})|N|Ⅱ|Ⅲ|Ⅳ|Ⅴ|Ⅵ|Ⅶ)|([一二三四五六七八九十][○一二三四五六七八九十]?[一二三四五六七八九十]?))?(篇|部分|讲).{0,50}$",
    rf"^([^{_H}]{{0,4}}第((\d+)|([一二三四五六七八九十][○一二三四五六七八九十]?[一二三四五六七八九十]?))?章[^。]{{0,50}})$",
    rf"^([^{_H}]{{0,4}}第((\d+)|([一二三四五六七八九十][○一二三四五六七八九十]?[一二三四五六七八九十]?))?[爷节][^。]{{0,70}})$",
    r"^[一二三四五六÷七八九十][○-一二三四五六七八九十]?[○-一二三四五六七八九十]?(([、，。].+)|(.{0,50})$)",
    rf"^[\[【][{_H}a-zA-Z、~\d\-]{{1,20}}[\]】]",
    r"^[\(（][-一二三四五六七八九十(\+\\equiv)][○一二三四五六七八九十]?[○一二三四五六七八九十]?[）\)].+",
    rf"^((\d{{1,3}}\s*[\.，。﹒、．,{_H}a-zA-Z]\s*\D.*)|(\d{{1,3}}\s*[{_H}a-zA-Z\s\"“《]+))",
    r"^\d{1,3}(\s*[\.﹒．]\s*\d{1,3}){1}\s*(?!\s*[\.﹒．]\s*\d+)+",
    r"^\d{1,3}(\s*[\.﹒．]\s*\d{1,3}){2}\s*(?!\s*[\.﹒．]\s*\d+)+",
    r"^\d{1,3}(\s*[\.﹒．]\s*\d{1,3}){3}\s*(?!\s*[\.﹒．]\s*\d+)+",
    r"^\d{1,3}(\s*[\.﹒．]\s*\d{1,3}){4,}\s*(?!\s*[\.﹒．]\s*\d+)+",
    r"^[\(（]\s*\d\d?\d?\s*[）\)].+",
    r"^[1-9][0-9]?\s*\d?[）\)].+",
    rf"^([①②③④⑤⑥⑦⑧⑨⑩ⅡⅢⅣⅤⅥⅦⅧⅨⅩⅪⅫⅰⅱⅲⅳⅴⅵⅶⅷⅸ❶❷❸❹❺❻❼❽❾❿⓫⓬⓭⓮⓯⓰⓱⓲⓳⓴].+|[abcdef]\s*[,\.、][{_H}]+|[①②③④⑤⑥⑦⑧⑨⑩ⅡⅢⅣⅤⅥⅦⅧⅨⅩⅪⅫⅰⅱⅲⅳⅴⅵⅶⅷⅸⅹ❶❷❸❹❺❻❼❽❾❿⓫⓬⓭⓮⓯⓰⓱⓲⓳⓴]+[{_H}a-zA-Z\s]+)",
)
# What looks like a title's number but is a quantity, a year, a word.
NOT_TITLES = (
    r"^\d+\s?(\.\d+)*(年|世纪|月|型|期|种|个|岁|根|周|次|条|倍|度|毫升|克|毫克|千|万|号|亿|斤|点|分钟|株|项|点|名|组|余位|已经给出|对(?!于)).*",
    r"^\d+\s?(\.\d+)*(mm|％|cm|m|nm|km|kg|μ|g|mg|倍|元|s|min|h|Hz|%|kb|∼|=|点|°).*",
    r"^20\d\d版.*",
    r"^199\d.*",
    r"^[12]型糖尿病.*",
    r"[\[【]\s*\**(中[国图]分类号|[Dd][Oo][Ii]|Abstract|ABSTRACT|关键词|Keywords|KEYWORDS|摘要|Summary|编者按)\**\s*[\]】]",
    r"^一(切|批|战|线|些|群|点|般|型|部|条|氧|个|种|样|直|天|幅|次|定|边|起|战|来|担|旦|路|期|汽|锥状叶|是|侧|致|体化|提到|项|方面|开始|同|系列).*",
    r"^-\d.*",
    r"^\d+(\.\d+)?(元|年|天|月|小时|\-|\+|\*|➗|÷).*",
    r"^\d+~\d+个.+",
    r"^四(肢|肽|酸|分体|聚体|氯化碳|氢生物|链|体|联体|面体|线).*",
    r"^三(叉脑|战|线|叉神经|链结构|氧|酸循环|羧酸|烯生育|脂肪酰基甘油|联管|丁基|磷酸|酸环|尖杉|脑室|尖学说|角嵴|子养亲汤|七|核苷酸|硅酸镁|唑仑|要|不要|系法模式|体|螺旋|叉神经|酯血症).*",
    r"^二(腹|零|战|线|个|尖瓣|联管|侧|油|氧|战|维码|丁基|棱镜|甲基|乙基|丙基|丁基|胺|巯丙醇|甲双胍|盐酸|硫基|甲苯|型糖尿病).*",
    r"^(十二指肠|六淫|五苓散|十二经脉|二巯基丙醇|一分子|羧酸|一碳单位|五味子|五官科|18-三体综合征|十字|八宝门|五脏|六腑).*",
    r"^[-一二三四五六七八九十○]+[维件亿万千年月天是级大倍日种类个诊代根多名起位点氟氯株位味步氢胎岁下跟周次度升阶段].*",
    r"^[-一二三四五六七八九十○]+(聚体|星级|环|疗程|世纪|房室).*",
    r"^\[[abcdefghijk]\].+",
    r"^\[\s?\d+\s?\].+",
)
LOWEST = r"(要点：|推荐阅读资料|学习目标|病例|要点提示|学习要点|参\s*考\s*文\s*献|参考资料|教学要求|通讯作者|收稿日期教学内容|阅读文献|关键词|微信扫描|【中图分类号】|Summary|【摘要】|\[摘要\]|思考题|练习题|分析题|参考书|学生自测题|推荐网站|问题与思考|推荐书目|教学目标|内容提示|内容提要|知识点|小贴士|临床病例|二至丸|习题|KEY POINTS)"
STARTS = (
    r"^(第[一1](篇|部分|讲)[^。]{0,30})", r"^(第[一1]章[^。]{0,30})", r"^(第[一1]节[^。]{0,30})", r"^[-一][、，].+", r"^[\(（][-一][）\)].+", r"^1\s*[\.﹒．]?\s*\D+",
    r"^1(\s*[\.﹒．]\s*1){1,4}\s*(?!\s*[\.﹒．]\s*\d+)+", r"^[\(（]1[）\)].+", r"^①.+",
)
DRUG_MARKS = ("【药品名称】", "【成份】", "【性状】", "【适应症】", "【规格】", "【用法用量】")
GUIDELINE_MARKS = (
    r"^([［【\[][摘提]要[】］\]]\s*|摘要：|摘要目的：)", r"(通讯作者[;:：]|通信作者[;:：]|通讯作者邮箱[;:：]|通信作者单位[;:：])", r"基金项目", r"文献标识", r"中[国图]分类号", r"文章编号", r"专家共识|指南",
    r"(DOI[;:：]|doi[;:：]|Doi[;:：])", r"[【\[]?\s*(Abstract|ABSTRACT)\s*(OBJECTIVE|Objective)?\s*[】\]:：；]", r"([［【\[]关键词[】］\]]|关键词：)", r"([［【\[]\s*Key\s*words\s*[】］\]]|Key\s*words[:;：])",
)
FIELDS = {
    "chinese_abstract": r"^(#*\s*[【\[]\**[摘提]要[】\]]\s*\**|摘要：?|摘要目的：?)",
    "english_abstract": r"^[【\[]?\**\s*(Abstract|ABSTRACT)\s*(OBJECTIVE|Objective)?\s*\**[】\]:：；]?",
    "chinese_keyword": r"^(#*\s*[【\[](关\s?键\s?词|主\s?题\s?词|)[】\]]\s*|(关\s?键\s?词|主\s?题\s?词)：?)",
    "english_keyword": r"^#*[【\[]?\s*\**(Key\s*words|KEYWORDS|Subject\s*words)\**\s*[】\]:：；]?",
    "doi": r"^#*\s*((DOI|doi|Doi)[:;；：]|[【\[][Dd][Oo][Ii][】\]]|[【\[]中国分类号[\]】]|[【\[]文献标识码[】\]]).+",
    "chinese_author": r"^[【\[]?(通讯作者|通信作者|作者简介|E-mail|Email|通讯作者邮箱)[\:：；\]】].*",
    "english_author": r"^(\**Corresponding\s*authors\**?:|Email:)",
    "funding": r"^[【\[]?\s*(项目资助|项目基金|基金项目|Project\s*funding|Fund\s*program)\s*[】\]:：；]?",
}
WEBPAGE = r"^(https?:\/\/(?:[a-z\-]+\.)+[a-z]{2,}(?:\/[\-a-z\d%_.~+]*)*(?:\?[;&a-z\d%_.~+=-]*)?(?:\#[\-a-z\d_]*)?$)|^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
REFERENCE = r"^\[\s*\d+\s*].+"
TITLE_LABELS = {
    "说明书": "说明书|适应症|成分|处方信息要点|indications and usage|highlights of prescribing information",
    "指南": "指南|practice|guideline",
    "专家共识": "专家共识|专家建议|共识|建议",
    "临床研究": "研究|study|renal effects|clinical trial program|narrative review|trials|phase iii trials|phase i trials|phase ii trials",
}


def first_match(c: Column, patterns) -> Column:
    """Number of the first pattern that fits, from 1; 0 if none."""
    return F.coalesce(*[F.when(c.rlike(p), i + 1) for i, p in enumerate(patterns)], F.lit(0))


def not_title(c: Column) -> Column:
    return first_match(strip(c), NOT_TITLES)


def starts_level(c: Column) -> Column:
    return reduce(lambda a, b: a | b, [c.rlike(p) for p in STARTS])


def _bound(value: Column, use) -> Column:
    """use(value) with the value evaluated once, however often it is used: as the element of an array. Within a
    higher-order function Spark shares nothing else."""
    return F.transform(F.array(value), use)[0]


def title_slot(text: Column, attr: Column) -> Column:
    """Slot of a title's form: 0 to 13 by pattern, 14 and 15 unmarked, 16 lowest, -1 no title."""
    by_attr = F.when(attr == "text_title", 15).when(attr == "doc_title", 14).otherwise(-1)
    unmarked = F.when(attr == "doc_title", 15).when(attr == "text_title", 14).otherwise(-1)
    titled = attr.isin("doc_title", "text_title")

    def slot(t: Column) -> Column:
        found = F.coalesce(*[F.when(t.rlike(SLOTS[i]), i) for i in range(13, 1, -1)], F.lit(-1))
        early = F.when(t.rlike(SLOTS[0]), 0).when(t.rlike(SLOTS[1]), 1)
        bare = F.regexp_replace(t, r"^\d{1,3}\s*[\.﹒．]\s*", "")
        shaped = lambda f: (
            F.when(f.isin(3, 4, 6), F.when(not_title(t) > 0, by_attr).otherwise(f))
            .when(f == 7, _bound(not_title(t), lambda v: F.when(v.isin(2, 3, 4), -1).when(not_title(bare) > 0, 6).otherwise(7)))
            .when(f > -1, f).when(titled & t.rlike(LOWEST), 16).otherwise(unmarked)
        )
        short = F.length(F.regexp_replace(t, "[A-Za-z]+", "")) < 35
        return F.when(~contains_chinese(t) & t.contains("=+-√≤"), -1).otherwise(_bound(early, lambda e: F.when(e.isNotNull(), F.when(short, e).otherwise(-1)).otherwise(_bound(found, shaped))))

    return _bound(title_text(text), slot)


def title_text(text: Column) -> Column:
    """A title as it is matched: without outer white space and inline reference marks, a misread numeral put right."""
    return F.replace(F.regexp_replace(strip(text), r"<\d+-\d+>", ""), F.lit("\\equiv"), F.lit("三"))


def chinese_number(c: Column) -> Column:
    """0 to 100 from Chinese numerals; null for anything else."""
    ones = "一二三四五六七八九"
    names = {"零": 0, "十": 10, "一百": 100} | {o: i + 1 for i, o in enumerate(ones)}
    names |= {(t if n > 1 else "") + "十" + o: 10 * n + k for n, t in enumerate(ones, 1) for k, o in enumerate(("", *ones))}
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), c)


def book_index(c: Column) -> Column:
    """Number of a part or chapter."""
    n = F.regexp_extract(c, r"第([○-一二三四五六七八九十\d]*)(章|篇|部分).*", 1)
    return F.coalesce(F.when(n.rlike(r"^\d+$"), F.try_to_number(n, F.lit("999999999")).cast("int")), chinese_number(n), F.when(c.rlike("上篇"), 0).when(c.rlike("下篇"), 1))


def title_order(c: Column, slot: Column) -> Column:
    """Position among titles of the same level."""
    numeral = F.regexp_extract(c, r"\(?\s*([一二三四五六七八九十][一二三四五六七八九十]?[一二三四五六七八九十]?)\s*\)?", 1)
    digits = F.regexp_extract(c, r"(\d{1,9})", 1)
    return F.when(slot.between(0, 2), book_index(c)).when(slot.isin(3, 5), chinese_number(numeral)).when(slot.isin(6, 11, 12), F.try_to_number(digits, F.lit("999999999")).cast("int"))


def title_labels(c: Column) -> Column:
    t = F.lower(c)
    return F.array_compact(F.array(*[F.when(t.rlike(p), label) for label, p in TITLE_LABELS.items()]))


def marks(c: Column, patterns) -> Column:
    return sum((F.when(c.rlike(p), 1).otherwise(0) for p in patterns[1:]), F.when(c.rlike(patterns[0]), 1).otherwise(0))


def is_drug_sheet(c: Column) -> Column:
    return marks(c, DRUG_MARKS) >= 3


def is_guideline(c: Column) -> Column:
    return marks(c, GUIDELINE_MARKS) >= 2


def is_webpage(c: Column) -> Column:
    return c.rlike(WEBPAGE)


def is_english_title(c: Column) -> Column:
    """More than 5 and fewer than 100 words, no Chinese, no reference, no address."""
    n = F.size(F.array_remove(F.split(c, r"\s+"), ""))
    return ~contains_chinese(c) & ~c.rlike(REFERENCE) & ~is_webpage(c) & (n > 5) & (n < 100)


def is_field(c: Column, field: str) -> Column:
    return c.rlike(FIELDS[field])


# Titles at the beginning of a paragraph, in the order they are tried.
INLINE = (
    r"^[\[【][一-鿿、]{1,20}[】\]]",
    r"^\d+(\s*[\.﹒．]\s*\d+){1,5}\s*[\d一-鿿a-zA-Z\s\(\)αβ（）ⅡⅢⅣⅤⅥⅠ/、，\.,~‑\-]{1,30}[:：;；]",
    r"^\d+(\s*[\.﹒．]\s*\d+){1,5}\s*[\d一-鿿a-zA-Z\s\(\)αβ（）ⅡⅢⅣⅤⅥⅠ/、，\.,~‑\-]{1,50}[\(（][A-Za-z,‑\-\s]+[）\)]",
    r"^\d+(\s*[\.﹒．]\s*\d+){1,5}\s*[\d一-鿿a-zA-Z\(\)αβⅡⅢⅣⅤⅥⅠ（）/、~\-]{2,30}\s",
    r"^\d+(\s*[\.﹒．]\s*\d+){1,5}\s*[\d一-鿿a-zA-Z\s\(\)αβ（）ⅡⅢⅣⅤⅥⅠ/、，\.,~‑\-]{1,50}[\(（]",
    r"^\d+(\s*[\.﹒．]\s*\d+){1,5}\s*[一-鿿a-zA-Z\(\)αβⅡⅢⅣⅤⅥⅠ（）/、~\-]{1,30}[\(（]图\d+\-\d+[）\)]",
    r"^\d+(\s*[\.﹒．]\s*\d+){1,5}\s*[一-鿿a-zA-Z\(\)αβ（）/、~\-\s]{1,30}[①②③④⑤]",
    r"^\d+(\s*[\.﹒．]\s*\d+){1,5}\s*.{10}\]",
    r"^\d+\s*[一-鿿a-zA-Z，,\(\)\.\-‑（）/、~\s]{3,30}[:：;；]",
    r"^\d+\s*[一-鿿a-zA-Z\(\)\.\-‑（）/、~]{3,30}\s",
    r"^[^。！？!?,，]{3,30}[:：;；]",
    r"^[^。！？!?,，]{1,30}[\(（][A-Za-z,\s\-]+[）\)]",
    r"^[^。！？!?,，\s][一-鿿a-zA-Z\(\)（）/、~\-]{3,30}\s",
    r"^[^。！？!?,，]{1,30}[\(（]图\d+\-\d+[）\)]",
    r"^[一-鿿a-zA-Z、,\(\)（）\s\.\d，]{1,30}[。?？！①②③④⑤]",
)
#: Patterns whose title is taken out of what follows, and the one that ends in a space.
TAKEN_OUT, SPACED = (0, 1, 2, 3, 4, 7), 3


def split_inline_title(c: Column) -> Column:
    """A paragraph with its leading title set apart; as it is where no pattern fits or it is all title.
    (Where a word segmenter is at hand, callers may split what no pattern fits.)"""
    t = strip(c)

    def split(i: int, p: str) -> Column:
        head = F.regexp_extract(t, p, 0)
        shown = F.substring(head, F.lit(1), F.length(head) - 1) if i == SPACED else head
        rest = F.substring(t, F.length(head) + 1, F.length(t)) if i in TAKEN_OUT else t
        return F.when(t.rlike(p), F.when(F.length(head) == F.length(t), c).otherwise(F.concat(shown, F.lit("\n\n"), rest)))

    return F.coalesce(*[split(i, p) for i, p in enumerate(INLINE)], c)
