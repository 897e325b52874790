"""Weather code tables of the two providers that send numeric codes."""

# Provider code -> condition name. They must stay as they are for
# results to agree across systems.
WMO_CONDITIONS = {
    0: "Clear", 1: "Clear", 2: "Clouds", 3: "Clouds",
    45: "Fog", 48: "Fog",
    51: "Drizzle", 53: "Drizzle", 55: "Drizzle",
    61: "Rain", 63: "Rain", 65: "Rain",
    71: "Snow", 73: "Snow", 75: "Snow",
    80: "Rain", 81: "Rain", 82: "Rain",
    95: "Thunderstorm", 96: "Thunderstorm", 99: "Thunderstorm",
}

TOMORROW_CONDITIONS = {
    1000: "Clear", 1001: "Clouds", 1100: "Clear", 1101: "Clouds", 1102: "Clouds",
    2000: "Fog", 2100: "Fog",
    4000: "Drizzle", 4001: "Rain", 4200: "Rain", 4201: "Rain",
    5000: "Snow", 5001: "Snow", 5100: "Snow", 5101: "Snow",
    8000: "Thunderstorm",
}

DEFAULT_CONDITION = "Clouds"
DEFAULT_TEMPERATURE = 25.0
KMH_PER_MS = 3.6
