"""Domain values the cleaning and quality rules must agree on.

FIXED VALUES - these must equal the source system's catalogues for results
to match; they are stated here verbatim, in their natural order.
"""

# --- fixed values: reference catalogues -------------------------------------
VALID_COUNTRIES = ["PE", "CO", "MX", "CL", "AR", "EC", "BR"]
VALID_CHANNELS = ["web", "app", "pos"]
VALID_TRANSACTION_TYPES = ["pago", "reversa", "retiro"]
VALID_TRANSACTION_STATUS = ["aprobado", "rechazado", "pendiente"]
VALID_CURRENCIES = ["PEN", "USD", "COP", "MXN", "CLP", "ARS"]
VALID_MERCHANT_CATEGORIES = [
    "retail", "restaurante", "farmacia", "supermercado", "tecnologia",
    "transporte", "educacion", "salud", "entretenimiento", "moda",
]
VALID_MERCHANT_STATUS = ["activo", "inactivo", "suspendido"]
VALID_RISK_LEVELS = ["bajo", "medio", "alto"]
VALID_USER_SEGMENTS = ["premium", "estandar", "nuevo"]

# Values accepted by the silver transaction rules (wider than the catalogues above).
TX_RULE_CHANNELS = ["web", "app", "pos", "kiosko"]
TX_RULE_TYPES = ["pago", "reversa", "retiro", "payment"]
TX_RULE_STATUS = ["aprobado", "rechazado", "pendiente", "procesado"]

# Key shapes.
TX_ID_PATTERN = r"^TXN-[0-9]{8}-[0-9]{5}$"
USER_ID_PATTERN = r"^USR-[0-9]{6}$"
MERCHANT_ID_PATTERN = r"^MCH-[0-9]{5}$"

# Placeholder tokens that mean "no value" (compared upper-cased, after trim).
PLACEHOLDER_TOKENS = [
    "N/A", "NA", "NULL", "NONE", "NODISPONIBLE", "NO DISPONIBLE", "NO_DISPONIBLE",
    "SIN_CORREO", "SIN CORREO", "SIN NOMBRE", "DESCONOCIDO",
]

# Country aliases -> ISO code (compared upper-cased).
COUNTRY_ALIASES = {
    "PE": ["PE", "PER", "PERU", "PERÚ"],
    "CO": ["CO", "COL", "COLOMBIA"],
    "MX": ["MX", "MEX", "MEXICO", "MÉXICO"],
    "CL": ["CL", "CHI", "CHILE"],
    "AR": ["AR", "ARG", "ARGENTINA"],
    "EC": ["EC", "ECU", "ECUADOR"],
    "BR": ["BR", "BRA", "BRASIL", "BRAZIL"],
}

# Merchant status: English -> Spanish.
STATUS_ALIASES = {"active": "activo", "suspended": "suspendido"}

# Risk-level tokens meaning "unclassified" (compared lower-cased).
UNCLASSIFIED_RISK = ["sin clasificar", "n/a", "na"]

# Segment aliases (compared lower-cased).
SEGMENT_ALIASES = {
    "estandar": ["standard", "std", "regular", "estándar", "estandar"],
    "premium": ["vip", "premium"],
    "nuevo": ["new", "nuevo"],
}

# Phone numbers: national prefix and subscriber length.
PHONE_COUNTRY_PREFIX = "51"
PHONE_LOCAL_DIGITS = 9

# Gold: channel keys, display names and groups; risk score points.
CHANNEL_KEYS = {"web": 1, "app": 2, "pos": 3}
CHANNEL_NAMES = {"web": "Web", "app": "App", "pos": "POS"}
CHANNEL_GROUPS = {"web": "Digital", "app": "Digital", "pos": "Physical"}
UNKNOWN_CHANNEL_KEY = 0
UNKNOWN_LABEL = "Unknown"
RISK_POINTS = {"alto": 60, "medio": 35, "bajo": 15}
RISK_POINTS_DEFAULT = 25
RISK_POINTS_REJECTED = 25
RISK_POINTS_REVERSE = 15
RISK_SCORE_CAP = 100
# Rejection message templates of the silver transaction rules ({...} are filled in).
MSG_NULL = "{field}: nulo crítico"
MSG_FORMAT = "{field}: formato inválido (esperado {shape})"
MSG_VALUE = "{field}: valor inválido '{value}' (esperado: {expected})"
MSG_NOT_POSITIVE = "amount: valor no positivo ({value})"
MSG_TX_DATE = "transaction_date: nulo o formato no reconocido (esperado yyyy-MM-dd o dd/MM/yyyy)"
MSG_REVERSAL_REFERENCE = "reference_id: nulo crítico cuando transaction_type=reversa"
TX_ID_SHAPE = "TXN-YYYYMMDD-NNNNN"
USER_ID_SHAPE = "USR-NNNNNN"
MERCHANT_ID_SHAPE = "MCH-NNNNN"
# Date layouts: transactions accept the first two, merchants / users all four.
DATE_LAYOUTS_TX = ["yyyy-MM-dd", "dd/MM/yyyy"]
DATE_LAYOUTS_MULTI = ["yyyy-MM-dd", "dd/MM/yyyy", "yyyy/MM/dd", "dd-MM-yyyy"]
# Reader options of the landing sources.
READ_DATE_FORMAT = "yyyy-MM-dd"
READ_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
DEFAULT_DELIMITERS = {"csv": ",", "txt": "|"}
# Amount text: characters removed.
AMOUNT_DROP_CHARS = r"[^0-9.,]"
SIGNED_AMOUNT_DROP_CHARS = r"[^0-9,.\-]"
# Amounts with commas: shape, and what a comma stands for.
AMOUNT_COMMA_SHAPES = [(r"^\d{1,3}(,\d{3})+(\.\d+)?$", ""), (r"^\d+,\d{1,2}$", ".")]
# --- end of fixed values ----------------------------------------------------

# Messages of the merchant / user rules (our own additions, not reference values).
MSG_BAD_DATE = "{field}: formato de fecha no reconocido"
MSG_BAD_EMAIL = "email: formato inválido"
