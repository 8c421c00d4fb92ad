from sitepulse.functions import jsoncols, rum, scalar, text, weburl

__all__ = ["jsoncols", "rum", "scalar", "text", "weburl"]
