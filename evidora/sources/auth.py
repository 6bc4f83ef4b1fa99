"""A token that is minted when needed and an authorised request that tries once more. Transport and clock are given."""

from __future__ import annotations

import base64
from collections.abc import Callable

from evidora.errors import ConfigError

#: Fixed values, in seconds.
EARLY, LIFETIME = 30, 3600


class Tokens:
    def __init__(self, client_id: str, secret: str, mint: Callable[[str], tuple[int, dict]], clock: Callable[[], float]):
        self._basic = base64.b64encode(f"{client_id}:{secret}".encode()).decode()
        self._mint, self._clock, self._token, self._until = mint, clock, None, 0.0

    def get(self) -> str:
        """The token; a new one where there is none or it ends within ``EARLY`` seconds."""
        if self._token is None or self._clock() >= self._until - EARLY:
            status, body = self._mint(self._basic)
            token, lifetime = body.get("access_token"), body.get("expires_in")
            if not 200 <= status < 300 or not isinstance(token, str) or not token:
                raise ConfigError("the token could not be minted", status=status)
            valid = isinstance(lifetime, (int, float)) and not isinstance(lifetime, bool)
            self._token, self._until = token, self._clock() + (lifetime if valid else LIFETIME)
        return self._token

    def forget(self) -> None:
        self._token = None

    def request(self, send: Callable[[str], tuple[int, object]]) -> tuple[int, object]:
        """``send`` with the token; a 401 is answered by one more try with a new one."""
        answer = send(self.get())
        if answer[0] == 401:
            self.forget()
            answer = send(self.get())
        return answer
