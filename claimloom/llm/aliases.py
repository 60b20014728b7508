"""Common synonyms of the canonical verdicts and predicates, by code.

The lists hold German and English everyday wordings.  They are the default of a parameter; entries of the
canonical tables themselves (label, hint, translations) come from those tables.
"""

VERDIKT_ALIASES = {
    "V01": ["im Scope", "passend", "Zielmaschine", "ja, passt", "ist im Scope"],
    "V02": ["nicht im Scope", "außerhalb Scope", "gehört nicht dazu", "passt nicht", "nicht passend", "keine Zielmaschine"],
    "V03": ["unklar", "bin nicht sicher", "nicht sicher", "nicht entscheidbar", "weiß nicht"],
    "V04": ["keine Maschine im Bild", "kein Objekt erkennbar", "ohne Objekt", "nichts zu sehen"],
    "V05": ["Radfahrzeug", "auf Rädern", "Räder statt Ketten", "Radmaschine"],
    "V06": ["per Funk gesteuert", "Funkbedienung", "nur Funk", "Funkfernsteuerung"],
    "V07": ["autonomes Fahrzeug", "fahrerlos", "fahrerlos, autonom", "selbstfahrend ohne Fahrer"],
    "V08": ["zu kleine Maschine", "viel zu klein", "zu gering"],
    "V09": ["Prototypenstudie", "Studie / Prototyp", "nur Einzelstück", "Konzeptstudie"],
    "V10": ["nur Anbaugerät", "Anbau-Werkzeug", "nur Werkzeug", "Anbauteil"],
    "V11": ["gebraucht", "Gebrauchtinserat", "Gebrauchtmaschine", "Gebrauchtanzeige"],
    "V12": ["Doppel", "doppelter Eintrag", "schon vorhanden", "Duplikat", "bereits vorhanden"],
}

PREDICATE_ALIASES = {
    "legal_name": ["name of company", "company name", "Firma", "Firma (Name)", "Firmierung", "Unternehmensname", "Name der Firma"],
    "address": ["addr.", "Adresse", "postal address", "Postanschrift", "street address"],
    "lei": ["LEI", "LEI code", "LEI-Kennung"],
    "company_number": ["registration number", "reg. number", "Registernr.", "HR-Nummer", "Handelsregisternummer", "HRB", "register number"],
    "vat_valid": ["VAT valid?", "vat ok", "USt-ID gültig", "Umsatzsteuer-ID gültig"],
    "domain": ["website", "website domain", "Webdomain", "Domain (Web)", "Homepage", "URL"],
    "entity_status": ["status of entity", "company status", "Status der Firma", "Unternehmensstatus"],
    "managing_director": ["mgmt. director", "Geschäftsführer", "GF", "CEO", "director"],
    "oem_status": ["is OEM", "OEM", "Hersteller-Status", "ist Hersteller"],
    "pattern_code": ["pattern", "Bauform", "Pattern-Code", "code of pattern"],
    "patent_count": ["patents", "Anzahl Patente", "Patente", "patent number count"],
    "radio_approval": ["radio appr.", "Funk-Zulassung", "radio licence"],
    "weight_t": ["weight (t)", "Gewicht", "Gewicht t", "Masse in t", "weight"],
    "power_kw": ["power", "engine power", "Leistung kW", "Leistung", "Motorleistung"],
    "can_bus": ["CAN", "CANbus", "CAN level", "CAN-Bus"],
    "hmi_type": ["HMI", "HMI-Typ", "operator interface", "Bedienung"],
    "price_eur": ["price", "Price (EUR)", "Preis", "Listenpreis €", "list price"],
    "founded_year": ["founded", "gegründet", "Baujahr der Firma", "foundation year", "Jahr der Gründung"],
    "employee_count": ["employees", "headcount", "Mitarbeiter", "staff", "Anzahl Mitarbeiter"],
    "product_line": ["product range", "Produktreihe", "range of products", "Sortiment"],
}
