"""Quality bands on prose in scripts other than Latin."""

import pytest

from tillstar.llm import quality_rules

PROSE = {
    "Cyrillic": "Рано утром рыбаки вышли к морю, чтобы проверить сети, оставленные накануне вечером. Погода обещала быть ясной, но старый Пётр всё равно взял с собой тёплый плащ и фонарь. За последние годы он привык не доверять спокойному небу: слишком часто ветер менялся ещё до полудня. Дети бежали по берегу следом, собирая ракушки и споря о том, чья лодка вернётся первой. На рынке уже ждали торговки, которые знали цену каждой рыбе и умели торговаться так, что даже опытный капитан уступал им половину. К обеду улицы наполнились запахом жареного лука, свежего хлеба и дыма, а вечером весь город собрался на площади слушать музыкантов из соседней деревни. Они играли долго, пока не погасли последние огни и не взошла луна. Бабушка рассказывала внукам, как однажды зимой залив замёрз и люди ходили пешком на остров за дровами. Никто ей сначала не верил, однако в церковной книге нашлась запись об этом удивительном годе, и споры прекратились сами собой. На следующий день учитель предложил школьникам нарисовать карту побережья и отметить на ней каждый маяк. Работа заняла больше недели: одни измеряли расстояния шагами, другие расспрашивали стариков, третьи переписывали названия из пожелтевших журналов. Когда карта была готова, её повесили в ратуше рядом с портретом основателя города, и путешественники до сих пор останавливаются перед ней, чтобы найти дорогу к дальним бухтам.",
    "Greek": "Το πρωί οι ψαράδες κατέβηκαν στο λιμάνι για να ετοιμάσουν τα δίχτυα τους. Ο ουρανός ήταν καθαρός, όμως ο γέρος καπετάνιος έλεγε πως ο άνεμος θα γυρίσει πριν από το μεσημέρι. Τα παιδιά έτρεχαν στην παραλία και μάζευαν κοχύλια, ενώ οι γυναίκες άνοιγαν τα μαγαζιά και άπλωναν φρούτα, ελιές και ζεστό ψωμί. Στην πλατεία δύο φίλοι συζητούσαν για την παλιά γέφυρα που χρειάζεται επισκευή, αλλά κανείς δεν ήξερε ποιος θα πληρώσει τα έξοδα. Το βράδυ ήρθαν μουσικοί από το διπλανό χωριό και έπαιξαν μέχρι αργά, ώσπου έσβησαν τα τελευταία φώτα. Η γιαγιά θυμήθηκε τότε έναν χειμώνα που χιόνισε τόσο πολύ, ώστε έκλεισαν όλοι οι δρόμοι και το σχολείο έμεινε κλειστό για τρεις εβδομάδες.",
    "Arabic": "في الصباح الباكر خرج الصيادون إلى البحر ليتفقدوا شباكهم التي تركوها مساء أمس. كانت السماء صافية، لكن الرجل العجوز أخذ معه معطفا ثقيلا ومصباحا لأنه لا يثق بهدوء الريح. ركض الأطفال على الشاطئ يجمعون الأصداف ويتجادلون حول القارب الذي سيعود أولا. وفي السوق انتظرت البائعات وصول السمك، وكن يعرفن ثمن كل نوع ويساومن حتى يتنازل أمهر التجار عن نصف الربح. عند الظهر امتلأت الشوارع برائحة الخبز الطازج والبصل المقلي، ثم اجتمع أهل المدينة في الساحة ليستمعوا إلى فرقة موسيقية جاءت من القرية المجاورة. حكت الجدة لأحفادها قصة شتاء بعيد تجمد فيه الخليج، فمشى الناس على أقدامهم إلى الجزيرة لجلب الحطب، ولم يصدقها أحد حتى وجدوا ذلك مكتوبا في كتاب قديم.",
    "Devanagari": "सुबह होते ही मछुआरे नदी की ओर चल पड़े ताकि रात को डाले गए जाल देख सकें। आसमान साफ़ था, फिर भी बूढ़े रामदीन ने अपने साथ कंबल और लालटेन रख ली, क्योंकि उसे हवा पर भरोसा नहीं था। बच्चे किनारे पर दौड़ते हुए सीपियाँ चुन रहे थे और झगड़ रहे थे कि किसकी नाव पहले लौटेगी। बाज़ार में औरतें दुकानें खोलकर ताज़े फल, सब्ज़ियाँ और गरम रोटियाँ सजा रही थीं। दोपहर तक गलियों में भुने प्याज़ की महक फैल गई, और शाम को पूरा कस्बा चौक में इकट्ठा हुआ जहाँ पड़ोस के गाँव से आए कलाकारों ने देर तक गीत सुनाए। दादी ने पोते को बताया कि एक बार इतनी बारिश हुई थी कि पुल बह गया और तीन हफ़्ते तक विद्यालय बंद रहा।",
    "Thai": "เช้าวันนั้นชาวประมงออกเรือไปตรวจดูอวนที่วางทิ้งไว้ตั้งแต่เมื่อคืน ท้องฟ้าแจ่มใสแต่ลุงแก่ยังหยิบเสื้อหนาและตะเกียงติดมือไปด้วยเพราะไม่ไว้ใจสายลม เด็กๆ วิ่งเล่นบนหาดทรายเก็บเปลือกหอยและเถียงกันว่าเรือของใครจะกลับมาก่อน ที่ตลาดแม่ค้ากำลังเปิดร้านจัดผลไม้ ผักสด และขนมอบใหม่ ตอนเที่ยงถนนเต็มไปด้วยกลิ่นหอมของอาหาร พอตกเย็นผู้คนทั้งเมืองมารวมตัวกันที่ลานกว้างเพื่อฟังนักดนตรีจากหมู่บ้านใกล้เคียง คุณยายเล่าให้หลานฟังว่าเคยมีปีหนึ่งฝนตกหนักจนสะพานพังและโรงเรียนต้องปิดนานถึงสามสัปดาห์",
    "Han": "清晨，渔民们沿着石阶走到港口，准备检查昨夜留下的渔网。天空看起来十分晴朗，可是老船长仍旧带上厚外套和灯笼，因为他不相信平静的海风。孩子们在沙滩上奔跑，一边捡贝壳，一边争论谁家的船会最先回来。市场里，商贩打开店门，摆出水果、蔬菜与刚出炉的面包。到了中午，街道弥漫着炒洋葱的香味；傍晚，全城居民聚集到广场，聆听邻村乐队演奏民间歌曲，直到最后一盏灯熄灭。祖母告诉孙子，许多年前冬天特别寒冷，海湾结了冰，人们步行去岛上砍柴。起初没有谁肯相信，后来在旧书里找到记录，争吵才慢慢停止。",
    "Kana": "朝早く、漁師たちは昨夜しかけた網を見るために港へおりていった。空はよく晴れていたが、年老いた船長は厚い上着とランプを持っていくことにした。静かな風をあまり信じていなかったからである。子どもたちは砂浜を走りまわり、貝がらを拾いながら、だれの船がいちばん先に帰ってくるかを言いあらそっていた。市場では店の人がくだものや野菜、焼きたてのパンをならべている。昼になると通りには玉ねぎをいためるにおいがただよい、夕方には町じゅうの人が広場に集まって、となり村から来た楽団の演奏に耳をかたむけた。祖母は孫に、むかし湾がすっかり凍った冬の話をしてくれた。",
    "Hangul": "이른 아침 어부들은 어젯밤에 던져 둔 그물을 살피려고 항구로 내려갔다. 하늘은 맑았지만 늙은 선장은 두꺼운 외투와 등불을 챙겼는데, 고요한 바람을 믿지 않았기 때문이다. 아이들은 모래밭을 뛰어다니며 조개껍데기를 줍고 누구의 배가 먼저 돌아올지 다투었다. 시장에서는 상인들이 가게 문을 열고 과일과 채소, 갓 구운 빵을 늘어놓았다. 점심 무렵 골목마다 양파 볶는 냄새가 퍼졌고, 저녁에는 온 마을 사람이 광장에 모여 이웃 마을 악단의 연주를 들었다. 할머니는 손자에게 바다가 꽁꽁 얼어붙었던 겨울 이야기를 들려주셨다. 처음에는 아무도 믿지 않았으나 오래된 책에서 기록이 발견되었다.",
}


@pytest.mark.parametrize("script", PROSE)
def test_clean_prose_is_kept_in_its_script(script):
    text = PROSE[script]
    whole, half, many, lines = quality_rules.judge(quality_rules.Bands())([text, text[: len(text) // 2], text[:80] * 60, f"{text[:40]}\n" * 400])
    assert whole["usable"] and whole["bad_chunk_share"] == 0
    assert whole["kept"] == (not whole["base_failed"])
    assert half["usable"] or half["base_failed"]
    assert not any(r["usable"] or r["kept"] for r in (many, lines))
    assert not any(r["kept"] and r["base_failed"] for r in (whole, half, many, lines))


def test_latin_text_is_judged_by_its_own_bytes():
    for text in ("plain text", "Größe, façade, señor – “œuvre” 😀", ""):
        data = text.encode()
        assert quality_rules.folded(text, data) is data
    mixed = "Αθήνα city"
    assert len(quality_rules.folded(mixed, mixed.encode())) == len(mixed)
    short = quality_rules.judge(quality_rules.Bands())(["清晨 and a few other words", PROSE["Han"]])
    assert [(r["kept"], r["usable"]) for r in short] == [(False, False), (False, True)]
