"""Words, weights and limits that results depend on. Operators take them as defaults."""

#: Fixed: second-level suffixes under which a domain has three labels.
COMPOUND_SUFFIXES = ("com.ru", "net.ru", "org.ru", "gov.ru", "edu.ru", "spb.ru", "msk.ru", "co.uk", "com.tr")

#: Fixed: mail providers whose domain says nothing of a company's site.
MAIL_PROVIDERS = (
    "gmail.com", "googlemail.com", "mail.ru", "bk.ru", "inbox.ru", "list.ru", "yandex.ru", "ya.ru", "yandex.com", "rambler.ru",
    "lenta.ru", "icloud.com", "outlook.com", "hotmail.com", "live.com", "yahoo.com", "proton.me", "protonmail.com", "ru.net",
)

#: Fixed: hosts that belong to no company.
NON_CORPORATE = (
    "115", "facebook.com", "instagram.com", "linkedin.com", "rutube.ru", "tiktok.com", "twitter.com", "wa.me", "whatsapp.com", "x.com", "yandex.ru",
    "yandex.com", "vk.com", "t.me", "telegram.me", "youtu.be", "youtube.com", "dzen.ru", "ok.ru", "ru.net", "digital.gov.ru", "reestr.digital.gov.ru",
)

#: Fixed: file endings of documents.
DOCUMENT_EXTENSIONS = (".pdf", ".doc", ".docx", ".xls", ".xlsx", ".csv", ".txt", ".json", ".zip", ".rar", ".7z")

#: Fixed: parts of a path or title by which a page's section is known, surplus first.
SECTION_HINTS = {
    "sales": ("/sale", "/sales", "/realiz", "/nelikvid", "/metallolom", "/scrap", "/demontazh", "/mtr", "/tmc", "реализ", "продаж", "неликвид", "остатк", "металлолом", "лом", "невостреб", "демонтаж", "отход", "вторсыр", "вторич", "tmc", "мтр"),
    "contacts": ("/contacts", "/contact", "/kontakt", "/kontakty", "контакт", "feedback", "rekvizit"),
    "about": ("/about", "/o-kompanii", "/company", "о компании", "about-us", "enterprise"),
    "products": ("/products", "/product", "/catalog", "/produk", "product", "catalog", "продук", "каталог"),
    "services": ("/services", "/service", "/uslug", "service", "услуг", "сервис"),
    "procurement": ("/procurement", "/purchases", "/zakupki", "/zakup", "/tenders", "/tender", "/torgi", "/torg"),
    "news": ("/news", "/press", "/blog", "news", "новост", "пресс"),
    "documents": ("/documents", "/document", "/docs", "/cert", "/sert", "/certificate", "сертифик", "документ"),
    "vacancies": ("/vacancies", "/career", "/jobs", "/vacanc", "/job", "ваканс", "карьер", "работ"),
    "branches": ("/branch", "/warehouse", "/office", "/filial", "/sklad", "филиал", "офис"),
    "files": ("/files", "/download"),
    "search": ("/search", "search?", "поиск", "query="),
}

#: Fixed: weights of words that identify an industrial site.
IDENTITY_KEYWORDS = {
    "завод": 3, "предприят": 2, "производ": 3, "изготов": 2, "переработ": 3, "цех": 2, "комбинат": 3, "фабрик": 3, "литейн": 3, "металл": 2, "металлоконструк": 3, "сталь": 2, "труба": 2,
    "арматур": 2, "листовой": 2, "переплав": 2, "станк": 2, "оборудован": 1, "машиностро": 3, "промышлен": 2, "конвейер": 1, "manufactur": 3, "factory": 3, "plant": 3, "processing": 3,
}

#: Fixed: weights of words of a commercial lead, by family.
LEAD_KEYWORDS = {
    "procurement": {"тендер": 3, "торги": 3, "закупк": 3, "аукцион": 3, "конкурс": 2, "запрос предложений": 2, "лот": 2, "извещение": 2, "документация": 1, "протокол": 1},
    "surplus/realization": {
        "реализац": 3, "лом": 2, "вторсыр": 2, "отход": 2, "неликвид": 3, "списан": 2, "демонтаж": 2, "металлоконструк": 3, "имущество": 1, "оборудован": 1,
        "складские остатки": 3, "невостребованные тмц": 3, "вторич": 2, "металлолом": 3,
    },
    "direct_sale": {"продаж": 2, "реализуем": 3, "коммерческое предложение": 2, "прайс": 1},
}

#: Fixed: weights of words that speak against a lead.
NEGATIVE_KEYWORDS = {"ваканс": 3, "политика конфиденциальности": 3, "пользовательское соглашение": 3, "cookie": 2, "о компании": 1, "контакты": 1, "новости компании": 1}

#: Fixed: the most that a group of signals may add.
GROUP_CAPS = {
    "industrial_identity_positive": 0.35, "product_or_process_positive": 0.45, "okved_code_positive": 0.35, "generic_corporate_weak": 0.15, "dealer_negative": 0.55,
    "portal_catalog_negative": 0.65, "marketplace_aggregator_negative": 0.7, "reseller_negative": 0.55, "unrelated_service_negative": 0.8,
}

#: Fixed: weights of an address's components.
ADDRESS_WEIGHTS = {"postal": 2, "region": 2, "district": 2, "city": 4, "settlement": 4, "territory": 3, "street": 5, "house": 6, "building": 2, "unit": 1}

#: Fixed: prices in USD per million tokens (input, cached input, output), as text for exact decimals.
MODEL_PRICES = {"mini": ("0.75", "0.075", "4.50"), "nano": ("0.20", "0.02", "1.25")}

#: Fixed: weights of the digits of a taxpayer id, for the check digits of 10 and of 12 digits.
INN_WEIGHTS_10 = (2, 4, 10, 3, 5, 9, 4, 6, 8)
INN_WEIGHTS_11 = (7, 2, 4, 10, 3, 5, 9, 4, 6, 8)
INN_WEIGHTS_12 = (3, 7, 2, 4, 10, 3, 5, 9, 4, 6, 8)
