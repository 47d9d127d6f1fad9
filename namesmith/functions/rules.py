"""Rule tables: fixed vocabularies of the domain, and the two knowledge tables that a user replaces with their own.

``CATALOGUE`` (keyword -> economic activity) and ``GAZETTEER`` (known employer -> name and activity) are compact
defaults. ``catalogue_rows`` and ``gazetteer_rows`` accept a full table as a parameter, in the same row form, and apply
its precedence: the last declaration of a key decides its value, the first its position.
"""

from __future__ import annotations

from typing import NamedTuple

# --- Fixed values: legal forms -------------------------------------------------------------------------------------
LEGAL_SUFFIXES = (
    "SA", "S A", "SAS", "S A S", "SRL", "S R L", "RL", "R L", "S DE R L", "SDERL", "CA", "C A", "CIA", "COMPANIA",
    "COMPANY", "CO", "CORP", "CORPORATION", "CORPORACION", "INC", "INCORPORATED", "LTD", "LTDA", "LIMITED", "LLC", "LP",
    "LLP", "PLC", "GMBH", "BV", "NV", "AG", "S P A", "SL", "S L", "EIRL", "AB",
)
LEGAL_FORM = {
    "S A": "S.A.", "SA": "S.A.", "S A S": "S.A.S.", "SAS": "S.A.S.", "S R L": "S. de R.L.", "SRL": "S. de R.L.",
    "R L": "S. de R.L.", "S DE R L": "S. de R.L.", "SDERL": "S. de R.L.", "C A": "C.A.", "CA": "C.A.", "CIA": "Cía.",
    "COMPANIA": "Cía.", "COMPANY": "Company", "CO": "Co.", "CORP": "Corp.", "CORPORATION": "Corporation",
    "CORPORACION": "Corporación", "INC": "Inc.", "INCORPORATED": "Inc.", "LTD": "Ltd.", "LTDA": "Ltda.",
    "LIMITED": "Limited", "LLC": "LLC", "LP": "LP", "LLP": "LLP", "PLC": "PLC", "GMBH": "GmbH", "BV": "B.V.",
    "NV": "N.V.", "AG": "AG", "S P A": "S.p.A.", "SL": "S.L.", "S L": "S.L.", "EIRL": "E.I.R.L.", "AB": "AB",
}

# --- Fixed values: token rewriting ---------------------------------------------------------------------------------
ABBREVIATIONS = {
    "ESC": "ESCUELA", "ESCU": "ESCUELA", "COLEG": "COLEGIO", "CEBG": "CENTRO EDUCATIVO BASICO GENERAL",
    "IPT": "INSTITUTO PROFESIONAL Y TECNICO", "UNIV": "UNIVERSIDAD", "INST": "INSTITUTO", "MIN": "MINISTERIO",
    "MINIST": "MINISTERIO", "MRIO": "MINISTERIO", "MEDUCA": "MINISTERIO DE EDUCACION", "MINSA": "MINISTERIO DE SALUD",
    "MOP": "MINISTERIO DE OBRAS PUBLICAS", "MIDA": "MINISTERIO DE DESARROLLO AGROPECUARIO",
    "MIDES": "MINISTERIO DE DESARROLLO SOCIAL", "MICI": "MINISTERIO DE COMERCIO E INDUSTRIAS",
    "MEF": "MINISTERIO DE ECONOMIA Y FINANZAS", "MITRADEL": "MINISTERIO DE TRABAJO Y DESARROLLO LABORAL",
    "CSS": "CAJA DE SEGURO SOCIAL", "ACP": "AUTORIDAD DEL CANAL DE PANAMA", "AMP": "AUTORIDAD MARITIMA DE PANAMA",
    "ATP": "AUTORIDAD DE TURISMO DE PANAMA", "IDAAN": "INSTITUTO DE ACUEDUCTOS Y ALCANTARILLADOS NACIONALES",
    "SENAFRONT": "SERVICIO NACIONAL DE FRONTERAS", "SENAN": "SERVICIO NACIONAL AERONAVAL",
    "SENADIS": "SECRETARIA NACIONAL DE DISCAPACIDAD",
    "IFARHU": "INSTITUTO PARA LA FORMACION Y APROVECHAMIENTO DE RECURSOS HUMANOS", "CONST": "CONSTRUCTORA",
    "CONSTR": "CONSTRUCTORA", "DISTRIB": "DISTRIBUIDORA", "DIST": "DISTRIBUIDORA", "IMP": "IMPORTADORA",
    "EXP": "EXPORTADORA", "INV": "INVERSIONES", "INVERS": "INVERSIONES", "SERV": "SERVICIOS", "SERVS": "SERVICIOS",
    "INT": "INTERNACIONAL", "INTL": "INTERNACIONAL", "INTER": "INTERNACIONAL", "TRANSP": "TRANSPORTE",
    "CORP": "CORPORACION", "AGROP": "AGROPECUARIA", "INDUST": "INDUSTRIAS", "IND": "INDUSTRIAS", "PROD": "PRODUCTOS",
    "COMERC": "COMERCIAL", "TECNOL": "TECNOLOGIA", "ADMIN": "ADMINISTRACION", "HOSP": "HOSPITAL", "CLIN": "CLINICA",
    "LAB": "LABORATORIO", "RESTAUR": "RESTAURANTE", "REST": "RESTAURANTE", "SUPERM": "SUPERMERCADO",
    "MINISUPER": "MINI SUPER", "PMA": "PANAMA", "PTY": "PANAMA", "ZL": "ZONA LIBRE", "ZLC": "ZONA LIBRE DE COLON",
}
CORRECTIONS = {
    "PANAMEA": "PANAMENA", "PANAMEAS": "PANAMENAS", "PANAMEO": "PANAMENO", "PANAMEOS": "PANAMENOS",
    "INVERCIONES": "INVERSIONES", "CONSTRUCION": "CONSTRUCCION", "CONSTRUCCIONE": "CONSTRUCCIONES",
    "SERVISIOS": "SERVICIOS", "COMPAIA": "COMPANIA", "ESPAA": "ESPANA", "SEORA": "SENORA", "NIOS": "NINOS",
    "DISEO": "DISENO", "DISEADORA": "DISENADORA", "MAANA": "MANANA", "ENSEANZA": "ENSENANZA",
}
STOPWORDS = ("DE", "DEL", "LA", "LAS", "EL", "LOS", "Y", "E", "EN", "A", "AL", "THE", "OF", "AND", "FOR")
#: Spelled-out words, (first part, second part, whole), in the order in which they are joined.
SPLIT_WORDS = (
    ("COMPA", "IA", "COMPANIA"), ("COMPAN", "A", "COMPANIA"), ("COMPA", "A", "COMPANIA"), ("PANAME", "AS", "PANAMENAS"),
    ("PANAME", "OS", "PANAMENOS"), ("PANAME", "A", "PANAMENA"), ("PANAME", "O", "PANAMENO"), ("DISE", "OS", "DISENOS"),
    ("DISE", "O", "DISENO"), ("EMPE", "OS", "EMPENOS"), ("EMPE", "O", "EMPENO"), ("ESPA", "A", "ESPANA"),
    ("CEDE", "O", "CEDENO"), ("ISTME", "A", "ISTMENA"), ("ISTME", "O", "ISTMENO"), ("DUE", "O", "DUENO"),
    ("DUE", "A", "DUENA"), ("A", "OS", "ANOS"), ("NI", "OS", "NINOS"), ("NI", "A", "NINA"), ("SE", "OR", "SENOR"),
    ("SE", "ORA", "SENORA"), ("CA", "A", "CANA"), ("MU", "OZ", "MUNOZ"), ("PE", "A", "PENA"),
    ("CASTA", "EDA", "CASTANEDA"), ("U", "AS", "UNAS"),
)
SPELLED_ACRONYMS = (("\\bP +H\\b", "PH"), ("\\bC +S +S\\b", "CSS"), ("\\bIN +DEPENDIENTE\\b", "INDEPENDIENTE"), ("^M +S\\b", "MINISUPER"))
TRUNCATED_STEMS = (("INDEPENDIEN", "INDEPENDIENTE"), ("JUBILAD", "JUBILADO"), ("PENSIONAD", "PENSIONADO"), ("DESEMPLEAD", "DESEMPLEADO"), ("UNIVERSIDA", "UNIVERSIDAD"), ("MINISTERI", "MINISTERIO"))
GLUED_SUFFIXES = ("SAS", "LTDA", "CORP", "INC", "LTD", "SRL", "SA", "CA")
NUMBER_BRANDS = ("SUPER 99", "CANAL 13", "CANAL 4", "RADIO 10", "FARMACIA 24", "MULTI 24", "PIO PIO 24", "GRUPO 5", "TIENDA 5", "BINGO 90")

# --- Fixed values: places and addresses ----------------------------------------------------------------------------
UNIT_TOKENS = ("APTO", "APT", "AP", "APARTAMENTO", "PISO", "LOCAL")
STRONG_ADDRESS = ("CALLE", "AVENIDA", "AVE", "AV", "CARRETERA", "AUTOPISTA", "TRANSISTMICA", "CORREGIMIENTO", "BARRIADA", "URBANIZACION", "URB", "BOULEVARD", "BULEVAR", "CALLEJON", "SENDERO", "DIAGONAL")
WEAK_ADDRESS = (
    "EDIFICIO", "EDIF", "APTO", "APT", "AP", "APARTAMENTO", "PISO", "LOCAL", "CASA", "TORRE", "PLAZA", "ENTRADA",
    "FRENTE", "DETRAS", "CONTIGUO", "ALTOS", "RESIDENCIAL", "BARRIO", "VIA", "KM", "KILOMETRO", "NO", "NRO", "NUMERO",
    "SECTOR", "MANZANA", "LOTE", "PARQUE", "INTERAMERICANA",
)
PLACES = (
    "PANAMA", "COLON", "CHIRIQUI", "VERAGUAS", "HERRERA", "COCLE", "DARIEN", "BOCAS DEL TORO", "LOS SANTOS", "ARRAIJAN",
    "LA CHORRERA", "SAN MIGUELITO", "DAVID", "SANTIAGO", "CHITRE", "PENONOME", "AGUADULCE", "LA CONCEPCION",
    "CHANGUINOLA", "BUGABA", "CAPIRA", "CHEPO", "TOCUMEN", "JUAN DIAZ", "BETHANIA", "CALIDONIA", "ANCON", "CHILIBRE",
    "PACORA", "ALBROOK", "COSTA DEL ESTE", "PUNTA PACIFICA", "EL DORADO", "VIA ESPANA", "MARBELLA", "OBARRIO",
    "PAITILLA", "CLAYTON", "AMADOR",
)
_NOT_A_PLACE = {"DEL", "DE", "LA", "EL", "LOS", "SAN", "SANTA", "VIA", "COSTA", "PUNTA", "VERAGUAS"}
PLACE_TOKENS = tuple(sorted({word for place in PLACES for word in place.split()} - _NOT_A_PLACE))
ADDRESS_NUMBER = "\\b(NO|NRO|N) *[0-9]+\\b|\\bCALLE +[0-9]+|\\b[0-9]+ *[A-Z]? *$"
PAYROLL_WORDS = ("PLANILLA", "PLANILLAS", "NOMINA", "ASALARIADO", "ASALARIADA")
#: "CASA" as part of a business or parish name, not of an address.
HOUSE_OF = "\\bCASA (DE|DEL|EL|LA|LOS|LAS|CURAL|MATRIZ|CENTRAL|FUNERARIA|COMERCIAL)\\b"

# --- Fixed values: markers of what isn't an employer -----------------------------------------------------------------
INACTIVE = (
    "JUBILADO", "JUBILADA", "PENSIONADO", "PENSIONADA", "RETIRADO", "RETIRADA", "DESEMPLEADO", "DESEMPLEADA",
    "AMA DE CASA", "AMO DE CASA", "ESTUDIANTE", "NO TRABAJA", "SIN TRABAJO", "SIN EMPLEO", "CESANTE", "AMA DE LLAVES",
    "ADMINISTRADORA DEL HOGAR", "ADMINISTRADOR DEL HOGAR", "ADMINISTRADORA DE SU HOGAR", "ADMINISTRADORA EL HOGAR",
    "ADMON DEL HOGAR", "ADMO DEL HOGAR", "ADMINISTRADORA DOMESTICA", "LABORES DEL HOGAR", "OFICIOS DEL HOGAR",
    "TAREAS DEL HOGAR", "NO LABORA", "NO ESTA LABORANDO", "NO ESTA TRABAJANDO", "QUEDO CESANTE",
    "ACABA DE QUEDAR CESANTE", "SIN EMPLEO ACTUAL",
)
ANNOTATIONS = (
    "CLIENTE FALLECIDO", "CLIENTE FALLECIDA", "FALLECIDO", "FALLECIDA", "DEPENDIENTE ECONOMICO", "DEPENDIENTE ECONOMICA",
    "MENOR DEPENDIENTE", "MENOR DE EDAD", "DEPENDIENTE DE TERCERO", "DEPENDIENTE DE UN TERCERO", "DEPENDIENTE", "MENOR",
    "CLIENTE", "CUENTA CANCELADA", "CUENTA CERRADA", "NO VERIFICADO", "POR VERIFICAR", "ACTUALIZAR", "REVISAR",
)
ANNOTATION_PREFIX = "DEPENDIENTE "
WAITING = ("ESPERANDO NOMBRAMIENTO", "POR NOMBRAR", "PENDIENTE DE NOMBRAMIENTO", "EN TRAMITE DE NOMBRAMIENTO", "ESPERA DE NOMBRAMIENTO")
INDEPENDENT = ("INDEPENDIENTE", "CUENTA PROPIA", "POR SU CUENTA", "AUTONOMO", "AUTOEMPLEADO", "NEGOCIO PROPIO", "FREELANCE", "INFORMAL", "BUHONERO")
OCCUPATIONS = (
    "TRABAJADOR", "TRABAJADORA", "TRABAJADORES", "ADMINISTRADOR", "ADMINISTRADORA", "ADMINISTRADORES", "COORDINADOR",
    "COORDINADORA", "ENTRENADOR", "EDUCADORA", "INSTALADOR", "PESCADOR", "DISENADORA", "ANALISTA", "ESPECIALISTA",
    "ESTILISTA", "TAXISTA", "EBANISTA", "ASISTENTE", "SECRETARIA", "SECRETARIO", "VENDEDOR", "VENDEDORA", "CONDUCTOR",
    "ALBANIL", "MECANICO", "COCINERO", "COCINERA", "GUARDIA", "DOCENTE", "PROFESOR", "PROFESORA", "MAESTRA", "MAESTRO",
    "ENFERMERO", "ENFERMERA", "OBRERO", "OBRERA", "EMPLEADO", "EMPLEADA", "OPERARIO", "SUPERVISOR", "GERENTE",
    "CONTADOR", "CONTADORA", "ABOGADO", "ABOGADA", "MEDICO", "ODONTOLOGO", "INGENIERO", "ARQUITECTO", "CHOFER",
    "JARDINERO", "PINTOR", "SOLDADOR", "ELECTRICISTA", "PLOMERO", "CAJERO", "CAJERA", "MENSAJERO", "RECEPCIONISTA",
    "BARBERO", "NINERA", "DOMESTICA", "AGRICULTOR", "GANADERO", "COMERCIANTE",
)
NULL_MARKERS = (
    "NA", "N A", "NO APLICA", "NINGUNO", "NINGUNA", "SIN INFORMACION", "SI", "S I", "NO SABE", "DESCONOCIDO",
    "PENDIENTE", "NULL", "NONE", "VACIO", "SIN DATO", "SIN DATOS", "NO DISPONIBLE", "NO REFIERE", "XX", "ZZ", "PRUEBA",
    "TEST", "ASDF", "QWERTY",
)
GIVEN_NAMES = (
    "JOSE", "MARIA", "JUAN", "CARLOS", "LUIS", "ANA", "PEDRO", "JORGE", "MIGUEL", "RICARDO", "ROBERTO", "FRANCISCO",
    "MANUEL", "ANTONIO", "RAFAEL", "DANIEL", "EDUARDO", "FERNANDO", "ALBERTO", "JAVIER", "ROSA", "CARMEN", "ELENA",
    "PATRICIA", "MARTA", "LAURA", "SANDRA", "GLORIA", "YOLANDA", "MARIBEL", "OMAR", "ABDIEL", "YARIELA", "ITZEL",
    "ARIEL", "EDWIN", "ELIECER", "AURELIO", "BENIGNO", "DEMETRIO", "EUCLIDES", "ROGELIO", "VIELKA", "MARISOL", "NITZIA",
)
SURNAMES = (
    "GUARDIA", "GONZALEZ", "RODRIGUEZ", "GOMEZ", "PEREZ", "MARTINEZ", "SANCHEZ", "RAMIREZ", "TORRES", "FLORES", "RIVERA",
    "GOMES", "CASTILLO", "JIMENEZ", "MORENO", "HERRERA", "MEDINA", "VARGAS", "CASTRO", "ORTEGA", "DELGADO", "GUERRA",
    "SANTAMARIA", "CEDENO", "BATISTA", "QUINTERO", "AROSEMENA", "BARRIA", "SAMANIEGO", "ATENCIO", "CABALLERO",
    "MENDIETA", "SANJUR", "AGUILAR", "BERNAL", "ESPINOSA", "MURILLO", "PINEDA", "SOLIS", "VEGA",
)
#: Situations in the order in which they are looked for.
SITUATIONS = (
    ("Ama de casa", ("AMA DE CASA", "AMO DE CASA", "AMA DE LLAVES", "ADMINISTRADORA DEL HOGAR", "ADMINISTRADOR DEL HOGAR", "ADMINISTRADORA DE SU HOGAR", "ADMINISTRADORA EL HOGAR", "ADMON DEL HOGAR", "ADMO DEL HOGAR", "ADMINISTRADORA DOMESTICA", "LABORES DEL HOGAR", "OFICIOS DEL HOGAR", "TAREAS DEL HOGAR")),
    ("Jubilado o pensionado", ("JUBILADO", "JUBILADA", "PENSIONADO", "PENSIONADA", "RETIRADO", "RETIRADA")),
    ("Estudiante", ("ESTUDIANTE",)),
    ("Desempleado", ("DESEMPLEADO", "DESEMPLEADA", "CESANTE", "NO TRABAJA", "SIN TRABAJO", "SIN EMPLEO", "NO LABORA", "NO ESTA LABORANDO", "NO ESTA TRABAJANDO", "QUEDO CESANTE", "ACABA DE QUEDAR CESANTE", "SIN EMPLEO ACTUAL")),
    ("Cliente fallecido", ("CLIENTE FALLECIDO", "CLIENTE FALLECIDA", "FALLECIDO", "FALLECIDA")),
    ("Menor de edad", ("MENOR DE EDAD", "MENOR DEPENDIENTE", "MENOR")),
    ("Dependiente económico", ("DEPENDIENTE ECONOMICO", "DEPENDIENTE ECONOMICA", "DEPENDIENTE", "DEPENDIENTE DE TERCERO", "DEPENDIENTE DE UN TERCERO")),
    ("Cuenta cerrada o cancelada", ("CUENTA CANCELADA", "CUENTA CERRADA")),
)
PREFIX_SITUATION = "Dependiente económico"

# --- Fixed values: sectors -------------------------------------------------------------------------------------------
SECTIONS = {
    "A": "Agricultura, ganadería, silvicultura y pesca", "B": "Explotación de minas y canteras",
    "C": "Industrias manufactureras", "D": "Suministro de electricidad, gas, vapor y aire acondicionado",
    "E": "Suministro de agua, alcantarillado y gestión de desechos", "F": "Construcción",
    "G": "Comercio al por mayor y al por menor", "H": "Transporte y almacenamiento",
    "I": "Alojamiento y servicios de comida", "J": "Información y comunicaciones",
    "K": "Actividades financieras y de seguros", "L": "Actividades inmobiliarias",
    "M": "Actividades profesionales, científicas y técnicas", "N": "Actividades de servicios administrativos y de apoyo",
    "O": "Administración pública y defensa; seguridad social obligatoria", "P": "Enseñanza",
    "Q": "Salud humana y asistencia social", "R": "Artes, entretenimiento y recreación",
    "S": "Otras actividades de servicios", "T": "Hogares como empleadores",
    "U": "Organizaciones y órganos extraterritoriales",
}
EXECUTIVE = {
    "A": "Agropecuario y pesca", "B": "Minería", "C": "Manufactura", "D": "Energía y servicios públicos",
    "E": "Energía y servicios públicos", "F": "Construcción", "G": "Comercio", "H": "Transporte y logística",
    "I": "Hotelería y restaurantes", "J": "Tecnología y comunicaciones", "K": "Financiero y seguros", "L": "Inmobiliario",
    "M": "Servicios profesionales", "N": "Servicios de apoyo empresarial", "O": "Sector público", "P": "Educación",
    "Q": "Salud", "R": "Entretenimiento y recreación", "S": "Otros servicios", "T": "Hogares empleadores",
    "U": "Organismos internacionales",
}
DIVISIONS = {
    "A01": "Agricultura, ganadería, caza", "A02": "Silvicultura y extracción de madera", "A03": "Pesca y acuicultura",
    "B07": "Explotación de minas y canteras", "B08": "Explotación de minas y canteras",
    "C10": "Elaboración de productos alimenticios", "C11": "Elaboración de bebidas",
    "C13": "Fabricación de productos textiles", "C14": "Confección de prendas de vestir",
    "C15": "Fabricación de cuero y calzado", "C18": "Impresión y reproducción de grabaciones",
    "C19": "Fabricación de coque y refinación de petróleo", "C20": "Fabricación de sustancias químicas",
    "C21": "Fabricación de productos farmacéuticos", "C22": "Fabricación de productos de caucho y plástico",
    "C23": "Fabricación de minerales no metálicos", "C25": "Fabricación de productos elaborados de metal",
    "C31": "Fabricación de muebles", "C32": "Industrias manufactureras diversas",
    "D35": "Suministro de electricidad y gas", "E36": "Suministro de agua", "E38": "Gestión de desechos y saneamiento",
    "F41": "Construcción de edificios y obras", "F43": "Actividades especializadas de construcción",
    "G45": "Comercio y reparación de vehículos", "G46": "Comercio al por mayor", "G47": "Comercio al por menor",
    "H49": "Transporte terrestre", "H50": "Transporte marítimo", "H51": "Transporte aéreo",
    "H52": "Almacenamiento y actividades de apoyo al transporte", "H53": "Actividades postales y de mensajería",
    "I55": "Alojamiento", "I56": "Servicio de comidas y bebidas", "J58": "Actividades de edición",
    "J59": "Actividades cinematográficas y de producción", "J60": "Programación y transmisión",
    "J61": "Telecomunicaciones", "J62": "Programación informática y consultoría", "K64": "Intermediación financiera",
    "K65": "Seguros y fondos de pensiones", "K66": "Actividades auxiliares financieras",
    "L68": "Actividades inmobiliarias", "M69": "Actividades jurídicas y de contabilidad",
    "M70": "Consultoría de gestión", "M71": "Arquitectura e ingeniería", "M72": "Investigación científica y desarrollo",
    "M73": "Publicidad y estudios de mercado", "M74": "Otras actividades profesionales",
    "M75": "Actividades veterinarias", "N77": "Alquiler y arrendamiento", "N78": "Actividades de empleo y tercerización",
    "N79": "Agencias de viajes y operadores turísticos", "N80": "Actividades de seguridad e investigación",
    "N81": "Servicios a edificios y paisajismo", "N82": "Actividades de apoyo a empresas", "O84": "Administración pública",
    "P85": "Enseñanza", "Q86": "Actividades de atención de la salud humana", "Q87": "Atención en instituciones",
    "R90": "Actividades creativas y artísticas", "R92": "Actividades de juegos de azar",
    "R93": "Actividades deportivas y de esparcimiento", "S94": "Actividades de asociaciones",
    "S95": "Reparación de computadores y efectos personales", "S96": "Otros servicios personales",
    "T97": "Hogares como empleadores", "U99": "Organizaciones y órganos extraterritoriales",
}
COMMERCIAL_PREFIXES = (("REFRI", "F", "43", 6), ("AGROVET", "M", "75", 7), ("AUTOREPUEST", "G", "45", 7))
NOT_APPROXIMATE = ("LABORATORIO", "GUARDIA", "PRODUCCION", "PRODUCTOS", "PRODUCTO", "SISTEMA", "SOLUTION", "BAKER")
ADDRESS_LABEL, MISSING_LABEL = "No identificable - Direcciones", "No identificable - Falta informacion"
NOT_EMPLOYER_LABEL, PENDING_LABEL = "No identificable - No es un empleador", "Pendiente de validación externa"
UNIDENTIFIED, NO_CORPORATE_LINK = "No identificable", "Sin vínculo laboral corporativo"
#: type -> (name, sector, score)
TYPE_LABELS = {
    "DIRECCION": (ADDRESS_LABEL, ADDRESS_LABEL, 92), "VACIO": (MISSING_LABEL, MISSING_LABEL, 95),
    "ANOTACION": (NOT_EMPLOYER_LABEL, NOT_EMPLOYER_LABEL, 90), "INACTIVO": (NOT_EMPLOYER_LABEL, NOT_EMPLOYER_LABEL, 92),
    "OCUPACION": ("Ocupación declarada sin empleador", NOT_EMPLOYER_LABEL, 85),
    "INDEPENDIENTE": ("Trabajador independiente", NOT_EMPLOYER_LABEL, 90),
}
EMPLOYER_TYPES = ("EMPRESA", "PERSONA_NATURAL")
SECTOR_KEEPERS = ("INDEPENDIENTE", "INACTIVO", "OCUPACION")

# --- Fixed values: display and scores --------------------------------------------------------------------------------
ACRONYMS = (
    "ACP", "CSS", "IDAAN", "MEDUCA", "MINSA", "MOP", "MIDA", "MIDES", "MICI", "MEF", "MIRE", "ATTT", "ATP", "AMP",
    "SENAN", "SENAFRONT", "SENADIS", "IFARHU", "IPT", "CEBG", "UTP", "UP", "UDELAS", "USMA", "UNACHI", "HSBC", "BBVA",
    "BAC", "BNP", "HP", "IBM", "BMW", "KFC", "PH", "ZL", "SA", "SAS", "LLC", "LTD", "INC", "CORP", "BV", "NV", "AG",
    "DHL", "UPS", "PWC", "KPMG", "EY", "TV", "FM", "AM", "GPS", "IT", "RH", "PYME",
)
CONNECTORS = ("DE", "DEL", "LA", "LAS", "EL", "LOS", "Y", "E", "EN", "A", "AL", "PARA", "POR", "CON", "THE", "OF", "AND", "FOR")
PUBLIC_HEADS = (
    "MINISTERIO", "AUTORIDAD", "CONTRALORIA", "TRIBUNAL", "ORGANO", "ASAMBLEA", "PROCURADURIA", "DEFENSORIA", "CAJA",
    "CUERPO", "POLICIA", "MUNICIPIO", "ALCALDIA", "JUNTA", "SECRETARIA", "DIRECCION", "GOBERNACION", "CORREGIDURIA",
    "UNIVERSIDAD", "ESCUELA", "COLEGIO", "INSTITUTO", "HOSPITAL", "POLICLINICA", "IGLESIA", "PARROQUIA", "FUNDACION",
    "EMBAJADA", "CONSULADO", "LOTERIA",
)
IDENTITY_FACTOR = {"gazetteer": 1.00, "llm_alta": 0.92, "reconstruccion": 0.85, "llm_media": 0.75, "llm_baja": 0.55, "reclasificacion_cluster": 1.00}
SECTOR_FACTOR = {
    "gazetteer": 1.00, "propiedad_horizontal": 0.94, "frase": 0.92, "token": 0.80, "propagacion_duda": 0.58,
    "token_aproximado": 0.62, "prefijo_comercial": 0.70, "llm_alta": 0.90, "llm_media": 0.72, "llm_baja": 0.50,
    "reclasificacion": 1.00, "sin_evidencia": 0.25,
}
BANDS = ((85, "automatico"), (70, "muestreo"), (50, "revision"))
PROFILE_PATTERNS = (
    ("DIR_via", "\\b(CALLE|AVE|AVENIDA|VIA|CARRETERA|AUTOPISTA|TRANSISTMICA|INTERAMERICANA)\\b"),
    ("DIR_inmueble", "\\b(EDIF|EDIFICIO|PH|APTO|LOCAL|PISO|CASA|TORRE|PLAZA|URB|URBANIZACION|BARRIADA|CORREGIMIENTO|FRENTE|DETRAS)\\b"),
    ("SUFIJO_SOCIETARIO", "(\\bS ?A|\\bSAS|\\bCORP|\\bINC|\\bLTD|\\bLTDA|\\bLLC|\\bCIA|\\bSRL)$"),
    ("INDEPENDIENTE", "INDEPENDIENTE|CUENTA PROPIA|AUTONOMO"),
    ("INACTIVO", "DESEMPLEAD|AMA DE CASA|JUBILAD|PENSIONAD|ESTUDIANTE|NO TRABAJA|SIN TRABAJO|RETIRAD"),
    ("NULO_EXPLICITO", "^(N ?/? ?A|NO APLICA|NINGUN[OA]?|SIN INFORMACION|S ?/? ?I|X{2,}|\\.+|-+|0+|NO SABE|DESCONOCIDO|PENDIENTE|NULL|NONE|VACIO)$"),
    ("GOBIERNO", "\\b(MINISTERIO|MINIST|ALCALDIA|MUNICIPIO|AUTORIDAD|CONTRALORIA|TRIBUNAL|ORGANO JUDICIAL|CAJA DE SEGURO|ASAMBLEA|PROCURADURIA|POLICIA|SENAFRONT|MEDUCA|MINSA|ACP)\\b"),
    ("EDUCACION", "\\b(ESCUELA|ESC|COLEGIO|UNIVERSIDAD|CENTRO EDUCATIVO|CEBG|IPT|INSTITUTO)\\b"),
    ("SALUD", "\\b(HOSPITAL|CLINICA|POLICLINICA|CENTRO DE SALUD|FARMACIA)\\b"),
    ("OCUPACION", "^(ANALISTA|ASISTENTE|SECRETARI|VENDEDOR|CONDUCTOR|TAXISTA|ALBANIL|MECANIC|COCINER|GUARDIA|DOCENTE|PROFESOR|ENFERMER|OBRERO|EMPLEAD|OPERARIO|SUPERVISOR|GERENTE|CONTADOR|ABOGAD|MEDICO)"),
    ("UNA_PALABRA", "^[^ ]+$"),
    ("CON_DIGITOS", "[0-9]"),
)


# --- Tunable constants -----------------------------------------------------------------------------------------------
class Settings(NamedTuple):
    generic_share: float = 0.0025
    generic_least: int = 2
    largest_block: int = 120
    rare_tokens: int = 3
    affix: int = 4
    affix_least: int = 6
    accept: tuple[float, float, float] = (82.0, 88.0, 94.0)
    prefix_least: int = 18
    field_limits: tuple[int, int] = (30, 40)
    cohesion: float = 86.0
    doubt: float = 76.0
    reclassify: float = 88.0
    approximate_ratio: float = 90.0
    approximate_weight: int = 6
    approximate_length: int = 7
    morphology_length: int = 4
    typo_length: int = 8
    typo_ratio: float = 90.0
    typo_gap: int = 2
    typo_weight: int = 7
    repair_df: int = 3
    repair_tail: int = 3
    glued_base: int = 5
    prefix_extra: int = 2
    strong_weight: int = 7
    batch: int = 40


SETTINGS = Settings()


# --- Replaceable knowledge -------------------------------------------------------------------------------------------
class Activity(NamedTuple):
    key: str
    section: str
    division: str
    weight: int


class Employer(NamedTuple):
    key: str
    name: str
    section: str
    division: str


#: Compact default of this engine's own choosing: "section/division/weight: keys".
CATALOGUE = """
A/01/7: FINCA, HACIENDA, AGROPECUARIA
A/03/8: PESQUERA
C/10/8: PANADERIA, EMPACADORA
C/10/7: HELADERIA
C/14/8: SPORTSWEAR
F/41/8: CONSTRUCTORA, CONSTRUCCIONES
F/43/8: ELECTROMECANICA, REFRIGERACION
G/45/8: TALLER, AUTOREPUESTOS
G/46/8: DISTRIBUIDORA, IMPORTADORA, EXPORTADORA
G/46/7: ZONA LIBRE
G/47/8: FERRETERIA, SUPERMERCADO, FARMACIA, MINI SUPER
G/47/7: ALMACEN, BOUTIQUE, ZAPATERIA
H/49/8: TRANSPORTE, ACARREOS
H/50/8: NAVIERA
H/53/8: MENSAJERIA
I/55/8: HOTEL, HOSTAL, INN
I/56/8: RESTAURANTE, CAFE, FONDA, PIZZERIA
J/61/8: TELECOMUNICACIONES
J/62/8: SOFTWARE, INFORMATICA
K/64/8: BANCO, FINANCIERA, COOPERATIVA, CASA DE EMPENO
K/65/8: SEGUROS, ASEGURADORA
L/68/8: INMOBILIARIA, BIENES RAICES
M/69/8: BUFETE, ABOGADOS
M/70/8: CONSULTORES
M/71/8: AGRIMENSURA, ARQUITECTOS
M/75/9: VETERINARIA, VETERINARIO
N/80/8: SEGURIDAD PRIVADA, VIGILANCIA
N/81/8: FUMIGADORA, LIMPIEZA
N/82/1: CORPORACION, GRUPO, INVERSIONES
N/82/3: SERVICIOS
O/84/9: MINISTERIO, ALCALDIA, MUNICIPIO
O/84/8: AUTORIDAD, CAJA DE SEGURO, CONTRALORIA
P/85/8: ESCUELA, COLEGIO, UNIVERSIDAD, ESTUDIANTE DE UNIVERSIDAD
P/85/3: INSTITUTO
Q/86/8: HOSPITAL, CLINICA, INSTITUTO ONCOLOGICO, LABORATORIO
R/93/8: GIMNASIO
S/94/8: IGLESIA, FUNDACION
S/96/8: LAVANDERIA, BARBERIA, FUNERARIA, SPA
"""
#: Compact default: key = section/division name.
GAZETTEER = """
CAJA SEGURO SOCIAL = O/84 Caja de Seguro Social
MINISTERIO EDUCACION = O/84 Ministerio de Educación
MINISTERIO SALUD = O/84 Ministerio de Salud
MINISTERIO OBRAS PUBLICAS = O/84 Ministerio de Obras Públicas
AUTORIDAD CANAL PANAMA = H/52 Autoridad del Canal de Panamá
IDAAN = E/36 Instituto de Acueductos y Alcantarillados Nacionales
UNIVERSIDAD PANAMA = P/85 Universidad de Panamá
UNIVERSIDAD TECNOLOGICA = P/85 Universidad Tecnológica de Panamá
SUPER 99 = G/47 Super 99
BANISTMO = K/64 Banistmo
BANCO NACIONAL PANAMA = K/64 Banco Nacional de Panamá
ASSA COMPANIA SEGUROS = K/65 ASSA Compañía de Seguros
EMPRESAS MELO = C/10 Empresas Melo
COPA AIRLINES = H/51 Copa Airlines
MINERA PANAMA = B/07 Minera Panamá
ERNST AND YOUNG = M/69 Ernst & Young
PROCTER AND GAMBLE = C/20 Procter & Gamble
"""


def catalogue_rows(rows=None) -> list[Activity]:
    """Distinct keys in order of first declaration with the values of the last; ``rows`` replaces the default."""
    if rows is None:
        rows = []
        for line in CATALOGUE.strip().splitlines():
            head, keys = line.split(": ")
            section, division, weight = head.split("/")
            rows += [Activity(key, section, division, int(weight)) for key in keys.split(", ")]
    found: dict[str, Activity] = {}
    for row in rows:
        found[row[0]] = Activity(row[0], row[1], row[2], int(row[3]))
    return list(found.values())


def gazetteer_rows(rows=None) -> list[Employer]:
    """Known employers, keys brought through the same abbreviations and stopwords as the names that look them up."""
    if rows is None:
        rows = []
        for line in GAZETTEER.strip().splitlines():
            key, value = line.split(" = ")
            pair, name = value.split(" ", 1)
            rows.append((key, name, *pair.split("/")))
    found: dict[str, Employer] = {}
    for key, name, section, division in rows:
        tokens = [w for t in key.split() for w in ABBREVIATIONS.get(t, t).split()]
        key = " ".join(t for t in tokens if t not in STOPWORDS)
        found[key] = Employer(key, name, section, division)
    return list(found.values())
